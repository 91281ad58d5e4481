import random

import numpy as np
import pytest
import xxhash

from wayforge.llm.common import Staging
from wayforge.llm.simhash import ball, ball_size, fingerprint, near_links, op12_simhash, simhash_components, spanning


def brute_fp(text):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    if not words:
        return 0
    k = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, radius):
    """component of each (doc_id, fp), by comparing all pairs of fingerprints."""
    fps = sorted({f for _, f in pairs})
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    every = np.asarray(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(every[i] ^ every[i + 1 :]) <= radius).tolist():
            parent[root(i + 1 + j)] = root(i)
    of = {f: root(i) for i, f in enumerate(fps)}
    low = {}
    for d, f in pairs:
        low[of[f]] = min(d, low.get(of[f], d))
    return {(d, f): low[of[f]] for d, f in pairs}


def test_query_against_all_pairs(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    short = spark.createDataFrame([(-5, "A b  c d e\tf"), (-4, "a B c d e f"), (-3, None), (-2, " \n"), (-1, "one two")], "doc_id long, text string")
    docs = docs.union(short)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    pairs = [(r.doc_id, brute_fp(r.text)) for r in docs.collect()]
    want = brute_components(pairs, 4)
    got = {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in op12_simhash(spark, str(tmp_path)).collect()}
    assert got == want
    assert len(set(want.values())) < len(pairs) - 20


def test_spanning():
    rng = np.random.default_rng(3)
    for n, m in ((1, 0), (40, 30), (300, 280), (300, 900)):
        u, v = rng.integers(0, n, m), rng.integers(0, n, m)
        parent = list(range(n))
        for _ in range(n):
            for a, b in zip(u.tolist(), v.tolist()):
                parent[a] = parent[b] = min(parent[a], parent[b])
        assert spanning(u, v, n).tolist() == parent


@pytest.mark.parametrize(("radius", "most"), [(1, 4_000_000), (3, 4_000_000), (4, 4_000_000), (4, 3000)])
def test_links_of_crowded_balls(spark, radius, most):
    rng = random.Random(radius)
    fps = {rng.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1}
    for centre in list(fps)[:8]:
        for _ in range(12):
            x = centre
            for _ in range(rng.randrange(8)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    staging = Staging(spark, "test-simhash")
    links = near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), radius, staging, slice_size=2000, most=most).collect()
    assert all(((r.u ^ r.v) & ((1 << 64) - 1)).bit_count() for r in links)
    ids = {f: i for i, f in enumerate(sorted(fps))}
    want = brute_components([(i, f) for f, i in ids.items()], radius)
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for r in links:
        parent[root(r.u % (1 << 64))] = root(r.v % (1 << 64))
    low = {}
    for f in fps:
        low[root(f)] = min(ids[f], low.get(root(f), ids[f]))
    assert {(ids[f], f): low[root(f)] for f in fps} == want


def test_parts():
    assert [ball_size(64, k) for k in range(3)] == [1, 65, 2081]
    assert len(set(ball(10, 2).tolist())) == ball_size(10, 2) and ball(0, 0).tolist() == [0]
    words = [b"w%d" % (i % 977) for i in range(40_000)]
    assert fingerprint(words, 4, 42) == brute_fp(b" ".join(words).decode())


def test_odd_rows(spark):
    rows = [(7, "same text of six words here"), (7, "other words that differ from those"), (7, "same text of six words here"), (9, "SAME text of six words here"), (None, "same text of six words here"), (3, None), (8, ""), (None, None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")
    got = sorted(((r.doc_id or 0, r.fp == 0, r.component_id) for r in simhash_components(docs).collect()), key=str)
    assert got == sorted([(7, False, 7), (7, False, 7), (7, False, 7), (9, False, 7), (0, False, None), (3, True, 3), (8, True, 3), (0, True, None)], key=str)
    assert simhash_components(docs.limit(0)).count() == 0
    bad = spark.range(2).selectExpr("id as doc_id", "cast(X'ff41fe' as string) as text")
    assert {r.component_id for r in simhash_components(bad).collect()} == {0}
