import random
import re

import pytest

from wayforge.llm.license_scan import BASE_PHRASES, TEMPLATES, WORDS, compile_template, op4_license_scan, scan_licenses, scan_text

SCAN = [compile_template("t", "<<optional>>this <<any 1 3>> is<<end>> licensed under the gnu license version <<match 2|3>>")]


def labels(text, automata=SCAN):
    return scan_text(text.encode(), automata)[5]


def test_optional_and_replaceable_regions():
    assert labels("licensed under the GNU license, version 3.") == "t"
    assert labels("Prose. This fine work is licensed under the GNU license; version 2") == "t"
    assert labels("licensed under the gnu license version 4") == "" == labels("licensed under a gnu license version 3")
    assert scan_text(b"a this work is licensed under the gnu license version 3 b", SCAN)[7] == [("t", 1, 11), ("t", 4, 11)]


def test_any_bounds():
    a = compile_template("x", "begin <<any 2 3>> end")
    hit = lambda t: a.match(t.encode().split(), 0)
    assert not hit("begin 1 end") and hit("begin 1 2 end") and hit("begin 1 2 3 end") and not hit("begin 1 2 3 4 end")


def test_bad_templates():
    with pytest.raises(ValueError):
        compile_template("x", "a <<optional>> b")
    with pytest.raises(ValueError):
        compile_template("x", "<<optional>>a<<end>>")


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places, found = [], set()
    for phrase, label in BASE_PHRASES.items():
        p = phrase.decode().split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                found.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(found))


ODD = ["cc by nc cc by nc", "xcc by nc", "CC-BY-NC 4.0", "Ünder the MIT License under the mit license", "", None, "under the mit license " * 30_000, "apache license version 2 apache license version 20", "cc bÿ nc"]


def test_base_columns_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate([*ODD, *ODD])] + [(None, "cc by nc", 1)], "doc_id long, text string, labels int")
    got = scan_licenses(docs).select("doc_id", "text", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert len(got) == 2 * len(ODD) + 1
    for r in got:
        assert tuple(r)[2:] == brute(r.text)
    assert scan_licenses(docs.limit(0)).count() == 0


def test_query_on_the_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op4_license_scan(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def pattern(markup):
    """The template as an expression over words that are each followed by a blank."""
    out = []
    for part in re.split(r"(<<[^>]*>>)", markup):
        if part == "<<optional>>":
            out.append("(?:")
        elif part == "<<end>>":
            out.append(")?")
        elif part.startswith("<<any "):
            low, high = part[6:-2].split()
            out.append(r"(?:\S+ ){%s,%s}" % (low, high))
        elif part.startswith("<<match "):
            out.append("(?:" + part[8:-2] + ") ")
        else:
            out += [re.escape(w) + " " for w in part.encode().translate(WORDS).decode().split()]
    return re.compile("".join(out))


def example(markup, rng):
    """A text that the template accepts, with or without its optional parts."""
    out, skip = [], 0
    for part in re.split(r"(<<[^>]*>>)", markup):
        if part == "<<optional>>":
            skip += 1 if skip or rng.random() < 0.5 else 0
            out.append("")
        elif part == "<<end>>":
            skip = max(0, skip - 1)
        elif skip:
            continue
        elif part.startswith("<<any "):
            out.append(" ".join(["name"] * int(part[6:-2].split()[0])))
        elif part.startswith("<<match "):
            out.append(part[8:-2].split("|")[0])
        else:
            out.append(part)
    return " ".join(out)


def test_labels_equal_regular_expressions():
    """Texts of all templates, whole or with one word lost, doubled or changed, against expressions of the same markup."""
    rng = random.Random(3)
    automata, patterns = [compile_template(k, v) for k, v in TEMPLATES.items()], {k: pattern(v) for k, v in TEMPLATES.items()}
    accepted = 0
    for label, markup in TEMPLATES.items():
        for kind in range(6):
            words = example(markup, rng).split()
            if kind >= 3:
                k = rng.randrange(len(words))
                words[k : k + 1] = ([], [words[k]] * 2, ["other"])[kind - 3]
            text = "Some prose " + " ".join(words) + ", and more."
            flat = " ".join(text.encode().translate(WORDS).decode().split()) + " "
            want = {k for k, p in patterns.items() if re.search(r"(?:^| )" + p.pattern, flat)} | set(filter(None, brute(text)[4].split(",")))
            got = scan_text(text.encode(), automata)
            assert set(filter(None, got[5].split(","))) == want and 0 <= got[6] <= 1
            accepted += label in want
    assert accepted >= 3 * len(TEMPLATES)
