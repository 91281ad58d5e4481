import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from wayforge.llm import collocations as m
from wayforge.llm.common import Staging

DOCS = "/root/testdata/sf0.001/documents.parquet"


def brute(rows, least=10, inside=50, top=2000):
    """rows (lang, text): the ranked phrases, counted one by one."""
    ones, more = {}, {}
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            f = more.setdefault(lang or "und", Counter())
            ones.setdefault(lang or "und", Counter()).update((x,) for x in w)
            for k in (1, 2, 3):
                f.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in more.items():
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {p[i : i + 2] for p, a in held.items() if len(p) == 3 for i in (0, 1) if 100 * a >= inside * f[p[i : i + 2]]}
        ranked = []
        for p, a in held.items():
            if len(p) == 2 and p in covered:
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(ones[lang].values())
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # blocks are reached in several cuts
        monkeypatch.setattr(m, "BLOCK_ITEMS", 1000)
        monkeypatch.setattr(m, "FAN_BITS", 2)
    docs = spark.read.parquet(DOCS).select("lang", "text")
    rows = [(r.lang, r.text) for r in docs.collect()]
    more = [("xx", "New York City. " * 12 + "new york " * 9 + "."), (None, "a b\tc! A B" * 11), ("xx", None), (None, ""), ("xx", "b " * 40)]
    rows += more
    got = found(m.collocations(docs.union(spark.createDataFrame(more, docs.schema)), least=3 if small else 10, top=50))
    assert got == brute(rows, least=3 if small else 10, top=50)


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DOCS}'")
    r = con.execute(m.OP11_SQL)
    at = [[c[0] for c in r.description].index(x) for x in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")]
    got = m.op11_collocations(spark, "/root/testdata/sf0.001")
    assert sorted(tuple(x[i] for i in at) for x in r.fetchall()) == found(got)
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}


def test_filters_lose_nothing():
    rng = np.random.default_rng(1)
    for bits, size in ((1, 2), (5, 2), (9, 3), (21, 3), (32, 3)):
        left = rng.integers(0, 1 << bits, 4000, dtype=np.uint64)
        right = rng.integers(0, min(1 << (bits * (size - 1)), 1 << 63), 4000, dtype=np.uint64)
        q, r = m.permuted(left, right, bits, bits * (size - 1))
        back = m.permuted(q, r, bits, bits * (size - 1), undo=True)
        assert (back[0] == left).all() and (back[1] == right).all()
        if bits > 21:
            continue
        items = m.summed(np.r_[q, q[:50]], np.r_[r, r[:50]])
        assert items[2].sum() == 4050 and dict(zip(zip(items[0].tolist(), items[1].tolist()), items[2].tolist())) == Counter(zip(np.r_[q, q[:50]].tolist(), np.r_[r, r[:50]].tolist()))
        low = int(items[0][0])
        again = m.from_filter(*m.to_filter(*items, low, (1 << bits) - low), low, (1 << bits) - low)
        assert all((x == y).all() for x, y in zip(items, again))


def test_levels_of_merging(spark):
    rng = np.random.default_rng(2)
    want, frames = Counter(), []
    for unit in range(9):
        left, right = rng.integers(1, 60, 3000, dtype=np.uint64), rng.integers(1, 12, 3000, dtype=np.uint64)
        want.update(zip(left.tolist(), right.tolist()))
        frames.append(m.blocks_of(*m.summed(*m.permuted(left, right, 6, 6)), 2, unit, 6, 1))
    import pandas as pd

    parts = spark.createDataFrame(pd.concat(frames), m.PARTS)
    got = m.merged_filters(parts, 6, 1, 5, 30, Staging(spark, "test-filters")).collect()
    assert {(r.w1, r.w2): r.a for r in got} == {k: v for k, v in want.items() if v >= 30}


def test_exact_scores_and_odd_rows(spark):
    big = spark.createDataFrame([(3_000_000_001, 5_000_000_000_007, 4_000_000_000_003)], "a long, x long, y long")
    r = big.select(m.floor_score("a", "x", "y").alias("s")).first()
    assert r.s == 10**6 * 3_000_000_001**2 // (5_000_000_000_007 * 4_000_000_000_003)
    docs = spark.createDataFrame([("en", "é ü. " * 10, 1), ("en", "x\x0by\tz " * 10, 2)], "lang string, text string, word int")
    assert [(r.phrase, r.a) for r in m.collocations(docs).orderBy("rank").collect()] == [("y z", 10), ("é ü", 10)]
    assert m.collocations(docs.limit(0)).count() == 0
    bad = spark.range(12).selectExpr("'en' as lang", "cast(X'ff2041fe' as string) as text")
    assert [r.a for r in m.collocations(bad).collect()] == [12]
