import random

import pandas as pd
import pytest

from wayforge.llm import ngram_join
from wayforge.llm.ngram_join import jaccard_components, keep_one_of_each, op10_ngram_jaccard


def shingles(text, width):
    words = [w for w in (text or "").encode().translate(ngram_join.hashed_texts.__globals__["LOWER"]).split()]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(docs, width, num, den):
    sets = {i: shingles(t, width) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def edits(base, k, rng, vocabulary):
    words = base.split()
    for _ in range(k):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return " ".join(words)


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 9, 20, 60, 150]))) for _ in range(30)]
    return [(i, edits(rng.choice(bases), rng.randrange(0, 4), rng, vocabulary)) for i in range(n)] + [(n, ""), (n + 1, None), (n + 2, " \n ")]


@pytest.mark.parametrize("width,num,den", [(3, 90, 100), (5, 80, 100)])
def test_equals_brute_force(spark, width, num, den):
    docs = corpus(width)
    got = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), width=width, num=num, den=den).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, width, num, den)


@pytest.mark.parametrize("cut", ["pivots", "parts", "rest"])
def test_large_regions_are_cut_and_stay_exact(spark, monkeypatch, cut):
    """Chains of edits: families hold several components, and are larger than one task takes."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(60))]
    for _ in range(150):
        texts.append(edits(rng.choice(texts[-6:]), 1, rng, vocabulary))
    docs = list(enumerate(texts))
    monkeypatch.setattr(ngram_join, "SMALL", 6)
    monkeypatch.setattr(ngram_join, "FAMILY", 0)
    monkeypatch.setattr(ngram_join, "MEETING", 20)
    monkeypatch.setattr(ngram_join, "MEETINGS", 10**6 if cut == "rest" else 0)
    if cut != "pivots":  # no pivot cuts anything
        monkeypatch.setattr(ngram_join, "_cut", lambda m, b, n, d, t: m.selectExpr("region", "rep", "region as pivot", "false as link"))
    got = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), width=3, num=90, den=100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, 3, 90, 100)


def test_overlaps_equal_set_intersections():
    import numpy as np

    rng = random.Random(1)
    make = lambda n: [np.asarray(sorted(rng.sample(range(1, 400), rng.randrange(0, 60))), np.uint64) for _ in range(n)]
    xs, ys = make(15), make(9)
    for columns in (7, 2048):
        got = ngram_join.overlaps(xs, ys, columns)
        assert got.tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in ys] for x in xs]
    assert ngram_join.overlaps([], ys).shape == (0, 9) and ngram_join.overlaps([xs[0][:0]], ys).sum() == 0


def test_texts_that_share_a_passage_are_no_copies(spark):
    """A third of the texts hold one passage, most of it in short ones; a few of them are near copies as well."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = words(60)
    texts = [words(rng.randrange(10, 90)) + (passage if i % 3 == 0 else []) + words(rng.randrange(1, 30)) for i in range(150)]
    texts += [t[:-1] + ["other"] for t in texts[:20]]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, 5, 80, 100)


@pytest.mark.parametrize("most", [ngram_join.LOCAL_BYTES, 1000])
def test_chains_of_short_texts_with_families_equal_brute_force(spark, monkeypatch, most):
    """Windows that slide over a text by a word: each is linked with its neighbours alone, in any order of ids; in a task a
    family, or by meetings where families have over a thousand bytes."""
    monkeypatch.setattr(ngram_join, "LOCAL_BYTES", most)
    monkeypatch.setattr(ngram_join, "MEETING_BYTES", 1500 if most == 1000 else ngram_join.MEETING_BYTES)
    rng = random.Random(4)
    texts = []
    for _ in range(150):
        long = [f"w{rng.randrange(100_000)}" for _ in range(60)]
        n, at = rng.randrange(14, 25), 0
        for _ in range(8):
            texts.append(" ".join(long[at : at + n + rng.randrange(2)]))
            at += rng.choice([1, 1, 2])
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    got = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), width=3, num=90, den=100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, 3, 90, 100)


def test_linked_sets_share_more_parts_than_spare():
    import numpy as np

    rng = random.Random(2)
    for num in (80, 90):
        for _ in range(1500):
            x = set(rng.sample(range(1, 10**9), rng.randrange(1, 90)))
            y = set(x)
            for _ in range(rng.randrange(0, 9)):
                y.discard(rng.choice(sorted(x)))
                if rng.random() < 0.6:
                    y.add(rng.randrange(1, 10**9))
            if y and x != y and 100 * len(x & y) >= num * len(x | y):
                a, b = (ngram_join.signatures(np.asarray(sorted(s), np.uint64), num, 100) for s in (x, y))
                assert len(a) <= 2 and len(b) <= 2
                assert any(s == t and len(set(p.tolist()) & set(q.tolist())) > s for s, p in a for t, q in b)


def test_join_region_is_exact():
    docs = [(i, t) for i, t in corpus(3, 80) if shingles(t, 3)]
    import numpy as np

    sets = [np.unique(np.asarray([hash(s) & (1 << 63) - 1 for s in shingles(t, 3)], np.uint64)) for _, t in docs]
    names = [i for i, _ in docs]
    links = ngram_join.join_region(names, sets, names, 90, 100)
    want = brute(docs, 3, 90, 100)
    comp = {i: i for i in names}
    for _ in names:
        for u, v in links:
            comp[u] = comp[v] = min(comp[u], comp[v])
    assert comp == {i: want[i][1] for i in names}


def test_cells_hold_each_linked_pair():
    import numpy as np

    docs = [(i, t) for i, t in corpus(4, 120) if len(shingles(t, 3)) > 3]
    sets = {i: np.unique(np.asarray([hash(s) & (1 << 63) - 1 for s in shingles(t, 3)], np.uint64)) for i, t in docs}
    members = pd.DataFrame([(1, i, s.tobytes()) for i, s in sets.items()], columns=["region", "rep", "blob"])
    pivots = pd.DataFrame([(i, sets[i].tobytes()) for i in list(sets)[::17]], columns=["pivot", "centre"])
    cells = ngram_join._cells(members, pivots, 90, 100).groupby("rep")["pivot"].apply(set)
    ids = list(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if ngram_join.linked(ngram_join.overlap(sets[i], sets[j]), len(sets[i]), len(sets[j]), 90, 100):
                assert cells[i] & cells[j]


def test_repeated_and_null_ids_and_empty(spark):
    docs = spark.createDataFrame([(5, "a b c d", 1), (5, "a b c d", 2), (3, "A b c d", 3), (None, "a b c d", 4), (9, "x " * 50_000, 5)], "doc_id long, text string, component_id int")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_components(docs, width=3).collect()), key=str)
    assert got == sorted([(5, 3), (5, 3), (3, 3), (None, None), (9, 9)], key=str)
    assert jaccard_components(docs.limit(0)).count() == 0
    kept = keep_one_of_each(spark, docs)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == [3, 9, None]


def test_one_of_each_keeps_unlinked_texts_of_a_repeated_id(spark):
    rows = [(5, "a b c d e f g h", "s", 1), (5, "q r s t u v w x", "s", 2), (5, "a b c d e f g h", "s", 1), (4, "A b c d e f g h", "s", 3), (7, "", "s", 4), (7, None, "s", 5), (None, "q r s t u v w x", "s", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _maybe string, stays int")
    kept = keep_one_of_each(spark, docs)
    assert kept.columns == docs.columns and sorted((r.stays for r in kept.collect())) == [2, 3, 4, 5, 6]
    assert keep_one_of_each(spark, docs.limit(0)).count() == 0


def test_a_row_without_an_id_does_not_hide_its_set(spark):
    words = [f"w{i}" for i in range(80)]
    docs = spark.createDataFrame([(None, " ".join(words)), (7, " ".join(words)), (3, " ".join([*words[:-1], "other"])), (9, " ".join(words[::-1]))], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    assert got == {None: None, 7: 3, 3: 3, 9: 9}


def test_query_equals_brute_force_on_the_table(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op10_ngram_jaccard(spark, d).collect()}
    assert got == brute(docs, 3, 90, 100)
