import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wayforge.llm.periodic_runs import op13_periodic_runs, periodic_runs, previous_smaller, runs_of


def brute(words, min_length=6, min_exponent=4):
    """All (start, length, period), by trying every period and keeping the smallest of equal stretches."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        x = 0
        while x + q < n:
            if words[x] != words[x + q]:
                x += 1
                continue
            y = x
            while y + q < n and words[y] == words[y + q]:
                y += 1
            if y + q - x >= max(min_length, min_exponent * q):
                found.setdefault((x, y + q), q)
            x = y + 1
    return sorted((x, y - x, q) for (x, y), q in found.items())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=5), st.sampled_from([(6, 4), (2, 2), (5, 3)]))
def test_runs_of_small_alphabets(texts, least):
    ids = np.asarray([w for t in texts for w in t], np.int64)
    rows = runs_of(ids, np.asarray([len(t) for t in texts], np.int64), *least)
    want = [(k, *r) for k, t in enumerate(texts) for r in brute(t, *least)]
    assert [tuple(r) for r in rows.tolist()] == want


def test_long_runs():
    rng = random.Random(5)
    for p, n in ((1, 700), (7, 900), (230, 1000)):
        head = [rng.randrange(50) for _ in range(rng.randrange(40))]
        unit = [rng.randrange(50) for _ in range(p)]
        words = head + [unit[i % p] for i in range(n)] + [rng.randrange(50) for _ in range(30)]
        assert [tuple(r[1:]) for r in runs_of(np.asarray(words), np.asarray([len(words)]), 6, 4).tolist()] == brute(words)


def test_smaller_values_of_stairs():
    v = np.r_[0, np.arange(1, 400), np.ones(300, np.int64), np.arange(1, 90)]
    for strict in (True, False):
        want = [max((j for j in range(i) if (v[j] < v[i] if strict else v[j] <= v[i])), default=-1) for i in range(len(v))]
        assert previous_smaller(v, strict)[1:].tolist() == want[1:]


def digest(doc_id, text):
    words = [] if text is None else [w for w in text.encode().split()]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    keep = [True] * n
    for s, m, q in runs:
        keep[s + q : s + m] = [False] * (m - q)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    collapsed = b" ".join(w for w, k in zip(words, keep) if k)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())


def test_query_on_short_documents(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 6000")
    more = spark.createDataFrame([(100_000 + i, " ".join("ab a c".split()[(i * j * j) % 3] for j in range(i % 60))) for i in range(300)], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(more)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = docs.collect()
    want = sorted(digest(r.doc_id, r.text) for r in rows)
    got = op13_periodic_runs(spark, str(tmp_path))
    assert dict(got.dtypes)["exponent_milli"] == dict(got.dtypes)["start"] == dict(got.dtypes)["n_runs"] == "bigint"
    assert sorted(tuple(r) for r in got.collect()) == want
    assert sum(r[1] > 0 for r in want) > 30


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "x " * 6), (4, "x " * 6), (None, "a b " * 5), (5, "é ü " * 4 + "é"), (6, "word " * 50_000)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, runs string")
    got = {(r.doc_id, r.n_words): ([tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect()}
    assert got[(1, 0)] == got[(2, 0)] == got[(3, 0)] == ([], "")
    assert got[(4, 6)] == ([(0, 6, 1)], "x")
    assert got[(None, 10)] == ([(0, 10, 2)], "a b")
    assert got[(5, 9)] == ([(0, 9, 2)], "é ü")
    assert got[(6, 50_000)] == ([(0, 50_000, 1)], "word")
    assert periodic_runs(docs).where("doc_id = 4").count() == 2
    assert periodic_runs(docs.limit(0)).count() == 0
    bad = spark.range(1).selectExpr("id as doc_id", "cast(X'ff20ff20ff20ff20ff20ff20fe' as string) as text")
    assert [tuple(x) for x in periodic_runs(bad).first().runs] == [(0, 6, 1)]
    with pytest.raises(ValueError):
        periodic_runs(docs, min_exponent=1)


def test_children_in_parts(monkeypatch):
    rng = random.Random(9)
    words = [rng.randrange(2) for _ in range(300)]
    monkeypatch.setattr("wayforge.llm.periodic_runs.WALKED", 7)
    monkeypatch.setattr("wayforge.llm.periodic_runs.JUMPS", 1)
    assert [tuple(r[1:]) for r in runs_of(np.asarray(words), np.asarray([300]), 2, 2).tolist()] == brute(words, 2, 2)
