import pytest

from wayforge.llm.common import fold
from wayforge.llm.language_id import identify_language, keep_identified, language_profiles, op6_language_id

TEXTS = [(0, "the house and the garden of the king", "en"), (1, "der garten und das haus des königs", "de"), (2, "the weather in the north", "en"), (3, "das wetter und der norden", "de")]


def rows(spark, given):
    return spark.createDataFrame(given, "doc_id long, text string, lang string")


def test_profiles_rank_most_frequent_first(spark):
    got = language_profiles(rows(spark, [(0, "aab", "x"), (1, None, "x"), (2, "b", None)])).orderBy("rank").collect()
    assert chr(got[0].gram) == "a" and [r.rank for r in got] == list(range(len(got)))


def test_edge_cases(spark):
    profiles = language_profiles(rows(spark, TEXTS))
    docs = spark.createDataFrame([(0, None, 1.0), (1, "", 1.0), (2, "123 !!", 1.0), (3, "und der " * 50_000, 1.0), (3, "und der " * 50_000, 1.0), (None, "the king", None)], "doc_id long, text string, score double")
    got = [(r.doc_id, r.lang_pred) for r in identify_language(docs, profiles).collect()]
    assert sorted(got, key=str) == sorted([(0, "und"), (1, "und"), (2, "und"), (3, "de"), (3, "de"), (None, "en")], key=str)


def test_empty_tables(spark):
    empty = rows(spark, [])
    assert language_profiles(empty).count() == 0
    assert identify_language(rows(spark, TEXTS[:1]), language_profiles(empty)).first().lang_pred == "und"
    assert identify_language(empty, language_profiles(rows(spark, TEXTS))).count() == 0


def test_grams_equal_counting_word_by_word():
    import re
    from collections import Counter

    from wayforge.llm.language_id import grams_of

    def code(gram):
        out = 0
        for c in gram:
            out = out << 21 | ord(c)
        return out

    for text in ("The cat, the CAT!", "é1b  c_d", "a", "", "12 -", "\U0001d41a\U0001d41bx y", "ß" * 50 + " x" * 99, "日本 語"):
        want = Counter()
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            padded = f" {word} "
            for n in (1, 2, 3):
                want.update(code(g) for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " ")
        assert dict(zip(*(x.tolist() for x in grams_of(text, 3)))) == want


def test_numbers_of_any_kind_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "½ ² Ⅷ ①②"), (2, "½ the king")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in identify_language(docs, language_profiles(rows(spark, TEXTS))).collect()}
    assert got == {1: "und", 2: "en"}


def test_pieces_of_long_texts_change_no_count(monkeypatch):
    from wayforge.llm import language_id

    text = "The cat and\nthe dog, " * 40 + "x" * 300 + " end. " + "a b " * 50
    want = dict(zip(*(x.tolist() for x in language_id._grams(text, 3))))
    for piece in (7, 50, 1000):
        monkeypatch.setattr(language_id, "PIECE", piece)
        assert "".join(language_id.pieces(text)) == text
        assert dict(zip(*(x.tolist() for x in language_id.grams_of(text, 3)))) == want


def test_query_equals_brute_force_on_the_table(spark, sf_dir):
    """Counting, ranking and distances once more with dictionaries."""
    import re
    import zlib
    from collections import Counter

    def grams(text):
        out = Counter()
        for word in re.findall("[^\\W\\d_]+", (text or "").lower()):
            padded = f" {word} "
            for n in (1, 2, 3):
                out.update(g for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " ")
        return out

    def ranked(counts):
        key = lambda g: [0] * (3 - len(g)) + [ord(c) for c in g]
        return sorted(counts, key=lambda g: (-counts[g], key(g)))[:400]

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    own = {r.doc_id: grams(r.text) for r in docs}
    sums = {}
    for r in docs:
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None:
            sums.setdefault(r.lang, Counter()).update(own[r.doc_id])
    profiles = {k: {g: i for i, g in enumerate(ranked(c))} for k, c in sorted(sums.items())}
    for r in op6_language_id(spark, sf_dir).collect():
        best = ranked(own[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if not best:
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        far = {k: sum(abs(p[g] - i) if g in p else 400 for i, g in enumerate(best)) for k, p in profiles.items()}
        k = min(far, key=lambda x: (far[x], x))
        assert r.lang_pred == k and abs(r.score - (1 - far[k] / (400 * len(best)))) < 1e-12


def test_too_many_languages(spark):
    with pytest.raises(ValueError):
        identify_language(rows(spark, TEXTS), language_profiles(rows(spark, TEXTS)), max_languages=1)


def test_held_out_accuracy(spark, sf_dir):
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = op6_language_id(spark, "/root/testdata/sf0.01").join(truth, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_stage_keeps_columns_and_clean_rows(spark):
    docs = rows(spark, TEXTS * 3 + [(9, "..", "en"), (10, None, None)]).withColumn("score", fold("doc_id", 3))
    kept = keep_identified(spark, docs)
    assert kept.columns == docs.columns and kept.count() == 12
    assert all(r.score == 5 for r in keep_identified(spark, docs.withColumn("score", docs["score"] * 0 + 5)).collect())
