import random

from wayforge.llm import decontamination
from wayforge.llm.decontamination import GAP, MATCH, MISMATCH, PLAIN, align, find_leaks, keep_uncontaminated, normal
from wayforge.llm.common import hashed_texts

PICK = random.Random(5)
VOCABULARY = ["".join(PICK.choice("abcdefghij") for _ in range(5)) for _ in range(400)]


def words(n, seed):
    pick = random.Random(seed)
    return [pick.choice(VOCABULARY) for _ in range(n)]


def slow(x, y):
    best, table = 0, [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(1, len(x) + 1):
        for j in range(1, len(y) + 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (MATCH if x[i - 1] == y[j - 1] else MISMATCH), table[i - 1][j] - GAP, table[i][j - 1] - GAP)
            best = max(best, table[i][j])
    return best


def test_alignment_equals_the_textbook():
    pick = random.Random(3)
    texts = [" ".join(pick.choice("abcd") for _ in range(pick.randrange(1, 30))) for _ in range(40)]
    hashes = list(hashed_texts(normal(texts), PLAIN))
    got, _ = align(hashes[:20], hashes[20:])
    assert got.tolist() == [slow(texts[i].split(), texts[i + 20].split()) for i in range(20)]


def fixture(spark):
    items = [words(40, 100 + i) for i in range(6)]
    edited = [w if i % 7 else "xx" for i, w in enumerate(items[1])]
    docs = [(i, " ".join(words(200, i))) for i in range(40)]
    docs += [(100, " ".join(words(50, 200) + items[0] + words(50, 201))), (101, " ".join(words(60, 202) + edited + words(10, 203))), (102, "! ".join(items[2]).upper()), (103, " ".join(items[3][:12] + words(40, 204)))]
    docs += [(104, None), (105, ""), (None, " ".join(items[4])), (106, " ".join(words(100_000, 9) + items[5])), (106, " ".join(words(100_000, 9) + items[5]))]
    bench = [(i, " ".join(x)) for i, x in enumerate(items)] + [(50, None), (51, "short one"), (None, " ".join(words(30, 900)))]
    return spark.createDataFrame([(i, t, "a") for i, t in docs], "doc_id long, text string, leaks string"), spark.createDataFrame(bench, "item_id long, text string")


def test_copies_and_edits_are_found_and_clean_texts_are_not(spark):
    docs, bench = fixture(spark)
    got = sorted(((r.doc_id, x.item_id) for r in find_leaks(docs, bench).collect() for x in r.leaks), key=str)
    assert got == sorted([(100, 0), (101, 1), (102, 2), (None, 4), (106, 5), (106, 5)], key=str)


def test_common_passage_is_still_found(spark):
    _, bench = fixture(spark)
    item = bench.where("item_id = 0").first().text
    docs = spark.createDataFrame([(i, " ".join(words(30, i)) + " " + item) for i in range(300)], "doc_id long, text string")
    assert find_leaks(docs, bench).where("leaks[0].item_id = 0").count() == 300


def test_edited_copies_are_found_as_by_alignment_of_all_pairs(spark):
    """Items of 15 to 59 words, a copy with a substitution every 5 to 8 words each; every second one stands whole, too."""
    pick = random.Random(12)
    items = [words(pick.randrange(15, 60), 1000 + i) for i in range(80)]
    docs = []
    for i, item in enumerate(items):
        step, start = 5 + i % 4, pick.randrange(5)
        copy = [f"x{i}y{k}" if k % step == start else w for k, w in enumerate(item)]
        docs.append((i, words(30, 2000 + i) + copy + words(20, 3000 + i)))
        docs += [(1000 + i, words(9, 4000 + i) + item)] * (i % 2 * 3)
    hashed = [list(hashed_texts(normal([" ".join(t) for t in x]), PLAIN)) for x in (items, [t for _, t in docs])]
    want = {(d[0], i) for i, x in enumerate(hashed[0]) for d, s in zip(docs, align([x] * len(docs), hashed[1])[0]) if s / (MATCH * len(x)) >= 0.5}
    assert {(i, i) for i in range(80)} <= want
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, x.item_id) for r in find_leaks(docs, bench).collect() for x in r.leaks} == want


def test_hits_in_parts_are_the_same(monkeypatch):
    import numpy as np

    items = [words(40, i % 7) for i in range(50)]
    p = decontamination.cut_items(list(range(50)), [" ".join(x) for x in items], 3, 8)
    (text,) = hashed_texts(normal([" ".join(words(50, 99) + items[3] + items[5][:30] + words(9, 98))]), PLAIN)
    whole = decontamination.leaks_of(text, decontamination.keep_held(p, np.unique(p.hashes)), 3, 0.5, 2)
    monkeypatch.setattr(decontamination, "HITS", 20)
    assert len(whole) > 7 and decontamination.leaks_of(text, p, 3, 0.5, 2) == whole


def test_long_items_and_empty_tables(spark):
    long_item = " ".join(words(1500, 77))
    bench = spark.createDataFrame([(1, long_item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(long_item.split()[310:720]))], "doc_id long, text string")
    assert find_leaks(docs, bench).first().leaks[0].item_id == 1
    assert find_leaks(docs, bench.limit(0)).first().leaks == []
    assert find_leaks(docs.limit(0), bench).count() == 0


def test_stage_keeps_columns(spark):
    docs, bench = fixture(spark)
    kept = keep_uncontaminated(spark, docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 6


def test_every_planted_passage_of_the_tables(spark):
    """Brute force: every benchmark text that stands in a document as it is."""
    from wayforge.llm.decontamination import op1_decontamination

    d = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet").collect()
    want = {(r.doc_id, b.item_id) for r in docs.select("doc_id", "text").collect() for b in bench if b.text in r.text}
    got = {(r.doc_id, r.item_id) for r in op1_decontamination(spark, d).collect()}
    assert want <= got


def test_short_items_leak_where_their_words_stand_whole(spark):
    bench = spark.createDataFrame([("a", "Alpha beta, gamma"), ("b", "delta"), ("c", "...")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "x ALPHA beta gamma y"), (2, "alpha gamma beta"), (3, "delta-force and delta"), (4, "alpha beta"), (5, None)], "doc_id long, text string")
    got = {(r.doc_id, x.item_id, x.score, x.first_word, x.last_word) for r in find_leaks(docs, bench).collect() for x in r.leaks}
    assert got == {(1, "a", 1.0, 1, 3), (3, "b", 1.0, 0, 0)}
    assert sorted(r.doc_id for r in keep_uncontaminated(spark, docs, bench).collect()) == [2, 4, 5]


def test_recall_by_share_of_edited_words(spark):
    """Substitutions, deletions and swaps of a share of the words at random places, against alignment of each pair."""
    pick = random.Random(21)
    items = [words(pick.randrange(15, 58), 5000 + i) for i in range(60)]
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    for share, least in ((0.05, 1.0), (0.1, 0.98), (0.2, 0.9)):
        docs = []
        for i, item in enumerate(items):
            copy = list(item)
            for k in sorted(pick.sample(range(len(copy)), max(1, int(share * len(copy)))), reverse=True):
                kind = pick.randrange(3)
                if kind == 0:
                    copy[k] = f"new{k}"
                elif kind == 1:
                    del copy[k]
                elif k:
                    copy[k - 1], copy[k] = copy[k], copy[k - 1]
            docs.append((i, " ".join(words(25, 6000 + i) + copy + words(25, 7000 + i))))
        x, y = (list(hashed_texts(normal(t), PLAIN)) for t in ([" ".join(x) for x in items], [t for _, t in docs]))
        want = {i for i, s in enumerate(align(x, y)[0]) if s / (MATCH * len(items[i])) >= 0.5}
        got = {(r.doc_id, l.item_id) for r in find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect() for l in r.leaks}
        assert all(i == j for i, j in got) and len(got) >= least * len(want)


def test_table_equals_alignment_of_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    x, y = (list(hashed_texts(normal([r.text for r in rows]), PLAIN)) for rows in (bench, docs))
    want = set()
    for d, text in zip(docs, y):
        for at in range(0, max(len(text), 1), 2000):  # pieces that overlap by more than an item's length
            piece = text[at : at + 2200]
            if len(piece):
                want |= {(d.doc_id, b.item_id) for b, i, s in zip(bench, x, align(x, [piece] * len(x))[0]) if s / (MATCH * len(i)) >= 0.5}
    got = {(r.doc_id, r.item_id) for r in decontamination.op1_decontamination(spark, sf_dir).collect()}
    assert got == want
