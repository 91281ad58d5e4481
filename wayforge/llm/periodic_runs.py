"""Runs of words that repeat with a period, found in an enhanced suffix array.

A text's suffixes are sorted by prefix doubling; neighbours' common prefixes follow from the ranks of each doubling.
Every LCP interval of depth d stands for a sequence of d words; two of its suffixes that are d words apart and in
different children are the last square of a run of period d. Of each interval all children but the largest are walked,
and ISA[i + d] and ISA[i - d] tell whether the other half of a square is in the interval. Rotating a square to the left
as far as it stays one gives the run; runs of the same words keep their smallest period. Many texts share one array.
"""

from __future__ import annotations

import functools
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayforge.llm.common import as_bytes

#: Words whose suffixes are sorted together, and suffixes of children that are walked at once, about.
TOGETHER, WALKED = 1 << 17, 1 << 20
#: Turns of pointer jumping before nearest smaller values are taken one by one.
JUMPS = 400


def sorted_suffixes(ids: np.ndarray, text: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(suffix array, ranks by the first 2**k words for each k, LCP of each suffix with the one before).

    ids: words of all texts, one after another; text: the text of each position; last: where its text ends. Suffixes
    end with their text, and texts are sorted one after another."""
    n = len(ids)
    order = np.lexsort((ids, text))
    new = np.ones(n, bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (ids[order][1:] != ids[order][:-1])
    rank, slot = np.empty(n, np.int64), np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(new, slot, 0))
    parted = np.where(new, 0, -1)  # the doubling that tells a suffix from the one before
    levels, step = [rank.astype(np.int32)], 1
    open_ = order[~(new & np.r_[new[1:], True])]
    while len(open_):
        after = open_ + step
        inside = after < last[open_]
        key = rank[open_] * (n + 1)
        key[inside] += rank[after[inside]] + 1
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        old = rank[open_]
        first = np.r_[True, old[1:] != old[:-1]]
        place = old + np.arange(len(open_)) - np.maximum.accumulate(np.where(first, np.arange(len(open_)), 0))
        fresh = np.r_[True, key[1:] != key[:-1]]
        order[place] = open_
        parted[place[fresh & ~first]] = len(levels)
        rank[open_] = np.maximum.accumulate(np.where(fresh, place, 0))
        levels.append(rank.astype(np.int32))
        step *= 2
        open_ = open_[~(fresh & np.r_[fresh[1:], True])]
    lcp = np.where(parted > 0, 1 << np.maximum(parted - 1, 0), 0)
    for k in range(len(levels) - 2, -1, -1):
        at = np.flatnonzero(parted > k + 1)
        a, b = order[at - 1] + lcp[at], order[at] + lcp[at]
        inside = np.maximum(a, b) < last[order[at]]
        at, a, b = at[inside], a[inside], b[inside]
        lcp[at[levels[k][a] == levels[k][b]]] += 1 << k
    return order, levels, lcp


def previous_smaller(v: np.ndarray, strict: bool) -> np.ndarray:
    """For each place with v > 0 the last one before it with a smaller value, or not strict with none larger; v[0] is 0."""
    at = np.arange(-1, len(v) - 1)
    todo = np.flatnonzero(v > 0)
    for _ in range(JUMPS):
        seen = v[at[todo]]
        todo = todo[seen >= v[todo] if strict else seen > v[todo]]
        if not len(todo):
            return at
        at[todo] = at[at[todo]]
    values, stack, out = v.tolist(), [], at.tolist()
    for i, x in enumerate(values):
        while stack and (values[stack[-1]] >= x if strict else values[stack[-1]] > x):
            stack.pop()
        out[i] = stack[-1] if stack else 0
        stack.append(i)
    return np.asarray(out)


def _spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each size, one after another."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def branching_squares(ids: np.ndarray, order: np.ndarray, lcp: np.ndarray, last: np.ndarray, deepest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of each square after whose end the period breaks. deepest: the largest period of each position."""
    n = len(ids)
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    v = np.r_[lcp, 0]
    bounds = np.flatnonzero((lcp > 0) & (lcp <= deepest[order]))
    before, up_to = previous_smaller(v, True), previous_smaller(v, False)
    mirror = v[::-1]
    after, down_to = n - previous_smaller(mirror, True)[::-1], n - previous_smaller(mirror, False)[::-1]
    opening = bounds[before[bounds] == up_to[bounds]]  # the first bound of its interval
    left = np.r_[bounds, before[opening]]
    size = np.r_[down_to[bounds] - bounds, opening - before[opening]]
    of = np.r_[bounds, opening]
    interval = np.unique(before[of] * (n + 1) + lcp[of], return_inverse=True)[1]
    by = np.lexsort((size, interval))
    small = by[:-1][interval[by][1:] == interval[by][:-1]] if len(by) else by  # all but the largest child of each
    left, size, of = left[small], size[small], of[small]
    starts, periods = [], []
    cuts = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()) + WALKED, WALKED)) if len(size) else []
    for x, y in zip(cuts[:-1], [*cuts[1:-1], len(size)]):
        i = order[_spread(left[x:y], size[x:y])]
        bound = np.repeat(of[x:y], size[x:y])
        d, low, high = lcp[bound], before[bound], after[bound]
        for j in (i, i - d):
            ok = np.flatnonzero((j >= 0) & (j + d < n))
            other = j[ok] + d[ok] if j is i else j[ok]
            ok = ok[(inverse[other] >= low[ok]) & (inverse[other] < high[ok])]
            s, p = j[ok], d[ok]
            end = s + 2 * p
            breaks = end == last[s]
            breaks[~breaks] = ids[(s + p)[~breaks]] != ids[end[~breaks]]
            starts.append(s[breaks])
            periods.append(p[breaks])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def runs_of(ids: np.ndarray, sizes: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period; sizes: words of each text."""
    sizes = np.asarray(sizes, np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    if not len(ids):
        return np.zeros((0, 4), np.int64)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    last = first + np.repeat(sizes, sizes)
    order, levels, lcp = sorted_suffixes(ids, text, last)
    s, p = branching_squares(ids, order, lcp, last, np.repeat(sizes // min_exponent, sizes))
    end, x = s + 2 * p, s.copy()
    for k in range(len(levels) - 1, -1, -1):  # rotate to the left
        back = x - (1 << k)
        ok = np.flatnonzero(back >= first[s])
        ok = ok[levels[k][back[ok]] == levels[k][back[ok] + p[ok]]]
        x[ok] = back[ok]
    long = end - x >= np.maximum(min_length, min_exponent * p)
    x, end, p = x[long], end[long], p[long]
    by = np.lexsort((p, end, x))
    x, end, p = x[by], end[by], p[by]
    same = np.r_[False, (x[1:] == x[:-1]) & (end[1:] == end[:-1])] if len(x) else np.zeros(0, bool)
    x, end, p = x[~same], end[~same], p[~same]
    by = np.lexsort((p, x))
    x, end, p = x[by], end[by], p[by]
    return np.stack([text[x], x - first[x], end - x, p], 1)


def least_repeat(min_length: int, min_exponent: int) -> int:
    """Words that a run has in common with itself one period later, at least."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))


def may_run(hashes: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Per text, whether any sequence of ``width`` words may occur twice in it; without one there is no run."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros(len(sizes), bool)
    if len(hashes) < width:
        return out
    m = len(hashes) - width + 1
    key = text[:m].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(width):
        key = (key ^ hashes[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    ranked = np.sort(key)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if len(twice):
        at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        out[text[:m][twice[at] == key]] = True
    return out


def _found(texts: list[list[bytes]], min_length: int, min_exponent: int) -> dict[int, np.ndarray]:
    """Rows (start, length, period) of each text that has runs."""
    sizes = np.asarray([len(t) for t in texts], np.int64)
    hashes = np.fromiter(map(hash, chain.from_iterable(texts)), np.int64, int(sizes.sum())).view(np.uint64)
    some = np.flatnonzero(may_run(hashes, sizes, least_repeat(min_length, min_exponent)))
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for k in some.tolist() for w in texts[k]), np.int64)
    rows = runs_of(ids, sizes[some], min_length, min_exponent)
    cuts = np.searchsorted(rows[:, 0], np.arange(len(some) + 1))
    return {int(k): rows[a:b, 1:] for k, a, b in zip(some, cuts[:-1], cuts[1:]) if b > a}


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that any run repeats."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs.tolist():
        keep[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(keep).tolist()])


_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _rows(batches, min_length: int, min_exponent: int):
    def flush(ids, texts):
        found = _found(texts, min_length, min_exponent)
        runs = [[{"start": s, "length": n, "period": p} for s, n, p in found[k].tolist()] if k in found else [] for k in range(len(texts))]
        whole = [_collapsed(t, found[k]) if k in found else b" ".join(t) for k, t in enumerate(texts)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(runs, _RUN), pa.array(whole, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    for batch in batches:
        ids, texts, size = [], [], 0
        for first in range(0, batch.num_rows, 100):
            part = batch.slice(first, 100)
            for i, data in zip(part.column(0).to_pylist(), as_bytes(part.column(1))):
                ids.append(i)
                texts.append(data.split())
                size += len(texts[-1])
                if size >= TOGETHER:
                    yield flush(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield flush(ids, texts)


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of docs.

    Words are runs without ASCII white space, numbered from 0. ``runs`` lists (start, length, period) by start and
    period: stretches of at least min_length words and min_exponent periods (two or more), of the smallest period, that no
    neighbouring word extends. ``collapsed`` is the text with one space between words and each run cut to its first
    period. Null and empty texts have no words and an empty result; rows may repeat, each has its own; ids are passed
    through, nulls too; an empty table gives no rows. Bytes that are not UTF-8 are words like others. Other columns are
    not read. Each text is whole in one task, which needs some 150 bytes a word for it."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    rows = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(functools.partial(_rows, min_length=min_length, min_exponent=min_exponent), _SCHEMA)
    return rows.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_planted_runs(text: str = "text", doc_id: str = "doc_id") -> Column:
    """The text, or for a tenth of the ids its words with a periodic rest; null ids keep their text."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    turns = F.ceil((n - a) / p).cast("int")
    rest = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), turns)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), rest), " ")
    return F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col(text))


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """The runs of all documents, a tenth of them with a planted one, as digests and the run of the highest exponent."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", with_planted_runs().alias("text"))
    found = periodic_runs(docs)
    # exact: length / period of two runs is compared crosswise
    best = F.aggregate(
        F.col("runs"),
        F.lit(None).cast("struct<start:long,length:long,period:long>"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    out = found.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
