"""Exact Jaccard self-join of shingle sets as a metric-space join.

Texts that share little are all at distance 1 from each other, so no document can serve as a pivot that tells them
apart. The first regions are therefore cut by the same metric on parts of the shingle universe: two sets within the
threshold differ in at most t shingles, so of K parts of the universe at least K - t hold equal subsets. A set leaves the
join unless it shares so many of its parts with others; sets that share one of the rarer of these parts are of one
family, and families are the first regions.

Inside the regions documents are pivots. A region that fits a task is joined there, pivot by pivot: distances to a
pivot link, and by the triangle inequality two members are compared only if their distances differ little enough. A
larger one is cut into Voronoi cells of pivots, with members near a border in each cell within the window, again and
again. What no pivot cuts, as all are about equally far, meets part by part, or all members meet those few that are
outside the largest component.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayforge.llm.common import Staging, as_bytes, columns_of, distinct, hashed_texts, mix, ngrams, row_hash, small
from wayforge.llm.graph import connected_components, filter_bits, may_hold, membership_filter

#: Families and regions up to these sizes are joined in one task; larger ones are cut.
FAMILY, SMALL = 400, 200
#: Bytes of sets that a region may have to be joined in one task.
LOCAL_BYTES = 96 << 20
#: Pivots that cut a region, at most.
PIVOTS = 24
#: Members and bytes of either side of a meeting of pivots with members, and the most meetings of two members by which a
#: whole family is joined so; beyond them its members meet part by part.
MEETING, MEETING_BYTES, MEETINGS = 1000, 8 << 20, 25_000_000


@functools.cache
def size_classes(num: int, den: int, most: int = 1 << 40) -> np.ndarray:
    """Lower bounds of the classes of set sizes; a partner is in the same or a neighbouring class."""
    bounds = [1]
    while bounds[-1] < most:
        bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * den * den // (num * num))))
    return np.asarray(bounds, np.int64)


def most_different(cls: int, num: int, den: int) -> int:
    """Shingles in which two linked sets differ at most, if the smaller one is in the class."""
    largest = int(size_classes(num, den)[cls + 1]) - 1
    return (largest + largest * den // num) * (den - num) // (den + num)


def signatures(s: np.ndarray, num: int, den: int) -> list[tuple[int, np.ndarray]]:
    """The regions of a sorted set of shingle hashes: for each class that a partner may use, (spare, one hash for each
    part), where linked sets share more than ``spare`` hashes. Classes whose linked sets are equal have none."""
    bounds, out = size_classes(num, den), []
    low, high = (int(np.searchsorted(bounds, k, "right")) - 1 for k in (-(-len(s) * num // den), len(s)))
    spread, value = mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), mix(s + np.uint64(0x1234567))
    for cls in range(low, high + 1):
        t = most_different(cls, num, den)
        if not t:
            continue
        spare = max(2, t // 3)
        k = t + 1 + spare
        part = spread % np.uint64(k)
        order = np.argsort(part.astype(np.uint16 if k < 1 << 16 else np.int64), kind="stable")
        part = part[order]
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        sums = np.zeros(k, np.uint64)
        sums[part[first].astype(np.int64)] = np.add.reduceat(value[order], first)
        out.append((spare, mix(sums + mix(np.arange(k, dtype=np.uint64) + np.uint64(cls * 1_000_003 + 17)))))
    return out


def shingle_set(h: np.ndarray, width: int) -> np.ndarray:
    return distinct(ngrams(h, width))


def _sets(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(doc_id, tid, n, a, sigs, first, spare, other) for rows (doc_id, tid, text): the set's size, a digest that names
    it, and, once in a task, its parts for one or two classes of sizes: ``first`` of them are of a class of which linked
    sets share more than ``spare``, the rest of one of which they share more than ``other``."""
    names = ["doc_id", "tid", "n", "a", "sigs", "first", "spare", "other"]

    def run(batches):
        seen = set()
        for batch in small(batches):
            n, a, sigs, numbers = [], [], [], []
            for i, h in zip(batch.column(0).to_pylist(), hashed_texts(as_bytes(batch.column(2)))):
                s = shingle_set(h, width)
                n.append(len(s))
                a.append(int(mix(s).sum(dtype=np.uint64)))
                own = signatures(s, num, den) if len(s) and i is not None and a[-1] not in seen else []
                if i is not None:
                    seen.add(a[-1])
                sigs.append(np.concatenate([x for _, x in own]).view(np.int64) if own else None)
                numbers.append((len(own[0][1]), own[0][0], own[-1][0]) if own else (0, 0, 0))
            columns = [pa.array(n, pa.int64()), pa.array(np.asarray(a, np.uint64).view(np.int64)), pa.array(sigs, pa.list_(pa.int64())), *(pa.array(x, pa.int32()) for x in (zip(*numbers) if numbers else ([], [], [])))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names)

    return docs.mapInArrow(run, "doc_id long, tid long, n long, a long, sigs array<long>, first int, spare int, other int")


def _met(sets: DataFrame, staging: Staging) -> DataFrame:
    """(rep, degree, sigs) of the sets that share enough of their parts: the rarer parts, of which linked sets share one.

    A part that very many sets have is one row of a partial sum in each task, and a hot key of a join that adaptive
    execution splits. Only parts that a filter takes for shared are shuffled for that join."""
    parts = sets.where("sigs is not null").select("a", "first", "spare", "other", F.posexplode("sigs").alias("at", "sig"))
    shared = staging.keep(parts.groupBy("sig").agg(F.min("a").alias("_x"), F.max("a").alias("_y"), F.count("*").alias("times")).where("_x < _y").select("sig", "times"), "shared")
    bits = filter_bits(shared.count())
    mine = parts.select("a", "sig", (F.col("at") < F.col("first")).alias("k"), F.when(F.col("at") < F.col("first"), F.col("spare")).otherwise(F.col("other")).alias("spare"))
    mine = may_hold(mine, "sig", membership_filter(shared, "sig", bits), bits).where("_maybe").drop("_maybe")
    held = mine.join(shared, "sig").groupBy("a", "k").agg(F.max("spare").alias("spare"), F.array_sort(F.collect_set(F.struct("times", "sig"))).alias("own")).where("size(own) > spare")
    rarer = held.select("a", F.slice("own", F.lit(1), F.size("own") - F.col("spare")).alias("own"))
    each = rarer.groupBy("a").agg(F.flatten(F.collect_list("own")).alias("own"))  # of two classes at most
    return each.select(F.col("a").alias("rep"), F.aggregate("own", F.lit(0).cast("long"), lambda x, y: x + y["times"]).alias("degree"), F.col("own.sig").alias("sigs"))


def _blobs(docs: DataFrame, width: int) -> DataFrame:
    """(rep, family, size, blob) for rows (rep, family, size, text): the set's sorted hashes as bytes."""

    def run(batches):
        for batch in small(batches):
            sets = [shingle_set(h, width).tobytes() for h in hashed_texts(as_bytes(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sets, pa.binary())], ["rep", "family", "size", "blob"])

    return docs.mapInArrow(run, "rep long, family long, size long, blob binary")


def _set(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint64)


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Shared values of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def linked(shared: int, x: int, y: int, num: int, den: int) -> bool:
    return den * shared >= num * (x + y - shared)


def join_region(names: list, sets: list[np.ndarray], comps: list, num: int, den: int) -> list[tuple]:
    """Links between members of different components, enough to connect all that are linked.

    Recursive: the first unconnected member becomes the pivot, distances to it are computed, those within the threshold link, and two
    others are compared only if their distances differ by no more than the threshold allows (triangle inequality)."""
    links, parent = [], {c: c for c in comps}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    order = sorted(range(len(names)), key=lambda i: (len(sets[i]), str(names[i])))
    eps = 1 - num / den
    far: list[np.ndarray] = []
    for pivot in order[:: max(1, len(order) // 4)][:4]:
        far.append(np.asarray([1 - (s := overlap(sets[i], sets[pivot])) / max(len(sets[i]) + len(sets[pivot]) - s, 1) for i in order]))
    table = np.stack(far, 1) if far else np.zeros((0, 0))
    sizes = np.asarray([len(sets[i]) for i in order])
    for k, i in enumerate(order):
        end = int(np.searchsorted(sizes, sizes[k] * den // num, "right"))
        near = np.flatnonzero((np.abs(table[k + 1 : end] - table[k]) <= eps + 1e-9).all(1)) + k + 1
        for m in near.tolist():
            j = order[m]
            if root(comps[i]) != root(comps[j]) and linked(overlap(sets[i], sets[j]), len(sets[i]), len(sets[j]), num, den):
                links.append((names[i], names[j]))
                parent[root(comps[i])] = root(comps[j])
    return links


def _cells(members: pd.DataFrame, pivots: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """For the members of a region: the distance to each pivot of whose cell it is part, at home or as a boundary copy."""
    eps, rows = 1 - num / den, []
    centres = sorted(((int(p), _set(b)) for p, b in zip(pivots["pivot"], pivots["centre"])), key=lambda x: x[0])
    for region, rep, blob in zip(members["region"], members["rep"], members["blob"]):
        s = _set(blob)
        shared = [overlap(s, c) for _, c in centres]
        far = [1 - o / max(len(s) + len(c) - o, 1) for o, (_, c) in zip(shared, centres)]
        home = min(far)
        for d, o, (p, c) in zip(far, shared, centres):
            if d <= home + 2 * eps + 1e-9:
                rows.append((region, rep, p, p != rep and linked(o, len(s), len(c), num, den)))
    return pd.DataFrame(rows, columns=["region", "rep", "pivot", "link"])


def _cut(members: DataFrame, blobs: DataFrame, num: int, den: int, turn: int) -> DataFrame:
    """(region, rep, pivot, link): the Voronoi cells of large regions; a region's members are spread over tasks by a salt."""
    salts = F.ceil(F.col("size") / 256).cast("int")
    spread = members.join(blobs.select("rep", "blob"), "rep").select("region", "rep", "blob", F.pmod(F.xxhash64("rep"), salts).cast("int").alias("salt"))
    centre = F.pmod(F.xxhash64("rep", F.lit(turn)), F.col("size")) < F.least(F.lit(PIVOTS), F.col("size") / 64)
    # the member that meets most others is always a pivot: of edited copies, the text they were made from
    first = members.groupBy("region").agg(F.max_by("rep", F.struct("degree", "rep")).alias("_first"))
    chosen = members.join(first, "region").where(centre | (F.col("rep") == F.col("_first"))).select("region", "rep", "size").distinct()
    chosen = chosen.join(blobs.select("rep", "blob"), "rep").select(F.col("region").alias("of"), F.col("rep").alias("pivot"), F.col("blob").alias("centre"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("part"))
    return spread.groupBy("region", "salt").cogroup(chosen.groupBy("of", "part")).applyInPandas(lambda m, p: _cells(m, p, num, den), "region long, rep long, pivot long, link boolean")


def _sift(members: DataFrame, blobs: DataFrame, num: int, den: int, staging: Staging) -> DataFrame:
    """The members of regions that share as many of all their hashes with others of the region as linked sets must."""

    def run(batches):
        for batch in small(batches, 100):
            for region, rep, blob in zip(*(c.to_pylist() for c in batch.columns)):
                s = _set(blob)
                yield pa.RecordBatch.from_arrays([pa.array([region] * len(s), pa.int64()), pa.array([rep] * len(s), pa.int64()), pa.array(s.view(np.int64)), pa.array([-(-len(s) * num // den)] * len(s), pa.int64())], ["region", "rep", "h", "need"])

    every = staging.keep(members.select("region", "rep").distinct().join(blobs.select("rep", "blob"), "rep").select("region", "rep", "blob").mapInArrow(run, "region long, rep long, h long, need long"), "region-sets")
    shared = every.groupBy("region", "h").agg(F.count("*").alias("times")).where("times > 1").select("region", "h")
    left = every.join(shared, ["region", "h"]).groupBy("region", "rep", "need").count().where("count >= need").select("region", "rep")
    left = members.join(left, ["region", "rep"], "left_semi").drop("size")
    sizes = left.groupBy("region").agg(F.countDistinct("rep").alias("size")).where("size > 1")
    return staging.keep(left.join(sizes, "region"), "sifted")


def _rest(members: DataFrame, blobs: DataFrame, num: int, den: int) -> DataFrame:
    """Links of regions that no pivot cuts: all members outside a region's largest component are pivots, in blocks of
    bounded bytes, and meet all members, in parts of bounded bytes, which are spread over tasks."""
    rows = members.select("region", "rep", "comp").distinct().join(blobs.select("rep", "blob"), "rep")
    counts = rows.groupBy("region", "comp").agg(F.count("*").alias("_n"), F.sum(F.octet_length("blob")).alias("_b"))
    largest = counts.groupBy("region").agg(F.max(F.struct("_n", "comp", "_b")).alias("_most"), F.sum("_n").alias("_all"), F.sum("_b").alias("_bytes"))
    share = lambda n, size: F.ceil(F.greatest(n / MEETING, size / MEETING_BYTES)).cast("int")
    largest = largest.select("region", F.col("_most.comp").alias("_largest"), share(F.col("_all") - F.col("_most._n"), F.col("_bytes") - F.col("_most._b")).alias("_blocks"), share(F.col("_all"), F.col("_bytes")).alias("_parts"))
    rows = rows.join(largest, "region")
    own = rows.select("region", "rep", "comp", "blob", F.pmod(F.xxhash64("rep"), "_parts").alias("part"), F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("block"))
    pivots = rows.where("comp <> _largest").select(F.col("region").alias("of"), F.col("rep").alias("pivot"), F.col("comp").alias("its"), F.col("blob").alias("centre"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - F.lit(1).cast("long"))).alias("at"), F.pmod(F.xxhash64("rep"), "_blocks").cast("int").alias("by"))
    return own.groupBy("region", "part", "block").cogroup(pivots.groupBy("of", "at", "by")).applyInPandas(functools.partial(_across, num=num, den=den), "u long, v long")


def overlaps(xs: list[np.ndarray], ys: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """Shared values of each set of xs with each of ys, as products of zero-one matrices over the values, some at a time."""
    out = np.zeros((len(xs), len(ys)), np.float32)
    values = distinct(np.concatenate(xs)) if xs else np.zeros(0, np.uint64)
    flat = []
    for sets in (xs, ys):
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        at = np.minimum(np.searchsorted(values, every), max(len(values) - 1, 0))
        known = values[at] == every if len(values) else np.zeros(len(every), bool)
        row, at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[known], at[known]
        order = np.argsort(at, kind="stable")
        flat.append((row[order], at[order]))
    for first in range(0, len(values), columns):
        sides = []
        for (row, at), n in zip(flat, (len(xs), len(ys))):
            low, high = np.searchsorted(at, (first, first + columns))
            m = np.zeros((n, columns), np.float32)
            m[row[low:high], at[low:high] - first] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return np.rint(out).astype(np.int64)


def _across(members: pd.DataFrame, pivots: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """Links between pivots and members of other components, one for each pivot and component."""
    if not len(members) or not len(pivots):
        return pd.DataFrame({"u": [], "v": []}, dtype="int64")
    xs, ys = [_set(b) for b in pivots["centre"]], [_set(b) for b in members["blob"]]
    shared = overlaps(xs, ys)
    union = np.asarray([len(x) for x in xs])[:, None] + np.asarray([len(y) for y in ys])[None] - shared
    i, j = np.nonzero((den * shared >= num * union) & (pivots["its"].to_numpy()[:, None] != members["comp"].to_numpy()[None]))
    found = pd.DataFrame({"u": pivots["pivot"].to_numpy()[i], "v": members["rep"].to_numpy()[j], "comp": members["comp"].to_numpy()[j]})
    return found.drop_duplicates(["u", "comp"])[["u", "v"]]


def _joined(members: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    members = members.drop_duplicates("rep")
    return pd.DataFrame(join_region(members["rep"].tolist(), [_set(b) for b in members["blob"]], members["comp"].tolist(), num, den), columns=["u", "v"])


def _still_open(members: DataFrame, found: DataFrame, staging: Staging) -> DataFrame:
    """The rows of regions that hold more than one component, with ``comp``."""
    named = members.join(found, members["rep"] == found["node"], "left").withColumn("comp", F.coalesce("component", "rep")).drop("node", "component")
    state = named.groupBy("region").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("region")
    return staging.keep(named.join(state, "region", "left_semi"), "open")


def _local(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links of regions (region, rep, comp, blob) that fit a task each."""
    return rows.select("region", "rep", "comp", "blob").groupBy("region").applyInPandas(lambda m: _joined(m, num, den), "u long, v long")


def _small(rows: DataFrame, blobs: DataFrame, num: int, den: int, staging: Staging) -> DataFrame:
    """Links of regions (region, rep, comp, and maybe their blob) of few members: in a task each, or, where a region's sets
    are too large together, by meetings of bounded bytes."""
    named = rows.select("region", "rep", "comp").distinct()
    with_blobs = rows if "blob" in rows.columns else named.join(blobs.select("rep", "blob"), "rep")
    if (blobs.agg(F.max("bytes")).first()[0] or 0) * max(FAMILY, SMALL) <= LOCAL_BYTES:
        return _local(with_blobs, num, den)
    bytes_ = named.join(blobs.select("rep", "bytes"), "rep").groupBy("region").agg(F.sum("bytes").alias("_b"))
    heavy = staging.keep(bytes_.where(F.col("_b") > LOCAL_BYTES).select("region"), "heavy")
    return _local(with_blobs.join(heavy, "region", "left_anti"), num, den).union(_rest(named.join(heavy, "region", "left_semi"), blobs, num, den))


def _connected(blobs: DataFrame, met: DataFrame, num: int, den: int, staging: Staging) -> DataFrame:
    """(node, component) of the linked sets of families (rep, family, size, blob), the roots among them."""
    members = blobs.select(F.col("family").alias("region"), "rep", "size", F.col("rep").alias("comp"), "blob")
    links = staging.keep(_small(members.where(F.col("size") <= FAMILY), blobs, num, den, staging), "links")
    todo = members.where(F.col("size") > FAMILY).select("region", "rep", "size", F.col("region").alias("family")).join(met.select("rep", "degree"), "rep")
    families = todo = staging.keep(todo, "large")
    n, level, last = todo.count(), 0, None
    while n and (last is None or n < 0.7 * last):
        last, cells = n, staging.keep(_cut(todo, blobs, num, den, level), "cells")
        links = staging.keep(links.union(cells.where("link").select(F.col("rep").alias("u"), F.col("pivot").alias("v"))), "links")
        found = connected_components(links, staging)
        if cells.count() > 3 * n:
            todo = _still_open(todo, found, staging)
            n = todo.count()
            break
        named = cells.select(F.xxhash64("region", "pivot").alias("region"), "rep").distinct()
        then = named.join(named.groupBy("region").agg(F.count("*").alias("size")), "region").join(families.select("rep", "family", "degree"), "rep")
        todo, level = _still_open(then, found, staging), level + 1
        if todo.where(F.col("size") <= SMALL).limit(1).count():
            links = staging.keep(links.union(_small(todo.where(F.col("size") <= SMALL), blobs, num, den, staging)), "links")
            todo = todo.where(F.col("size") > SMALL)
        todo = todo.drop("comp")
        n = todo.count()
    if n:  # no pivot cuts these
        links = staging.keep(links.union(_uncut(todo.drop("comp"), met, blobs, links, num, den, staging)), "links")
    return _with_roots(connected_components(links, staging))


def _uncut(todo: DataFrame, met: DataFrame, blobs: DataFrame, links: DataFrame, num: int, den: int, staging: Staging) -> DataFrame:
    """Links of the open regions whose members are about equally far from all pivots.

    Where few members are outside the largest component, or a region is not very large, these meet all others. Elsewhere members meet part by part: a
    small group in one task, and of a large one those members that share enough of all their shingles with the group."""
    found = connected_components(links, staging)
    open_ = _still_open(todo, found, staging)
    counts = open_.groupBy("region", "comp").agg(F.count("*").alias("_n")).groupBy("region").agg(((F.sum("_n") - F.max("_n")) * F.sum("_n")).alias("_meetings"))
    counts = staging.keep(counts, "outside")
    few = counts.where(F.col("_meetings") <= MEETINGS).select("region")
    more = [_rest(open_.join(few, "region", "left_semi").drop("degree", "family", "size"), blobs, num, den)]
    if not counts.where(F.col("_meetings") > MEETINGS).limit(1).count():
        return more[0]
    many = open_.join(few, "region", "left_anti").select("rep", "comp").distinct()
    held = many.join(met, "rep").select("rep", "comp", F.explode("sigs").alias("region")).distinct()
    groups = held.groupBy("region").agg(F.count("*").alias("size"), F.min("comp").alias("_x"), F.max("comp").alias("_y")).where("_x < _y").select("region", "size")
    held = staging.keep(held.join(groups, "region"), "by-part")
    more.append(_small(held.where(F.col("size") <= SMALL), blobs, num, den, staging))
    links = staging.keep(functools.reduce(DataFrame.union, more), "uncut")
    if not held.where(F.col("size") > SMALL).limit(1).count():
        return links
    found = connected_components(links, staging)
    left = _sift(_still_open(held.where(F.col("size") > SMALL).drop("comp"), found, staging), blobs, num, den, staging)
    left = _still_open(left.drop("comp"), found, staging)
    return links.union(_rest(left, blobs, num, den))


def _with_roots(found: DataFrame) -> DataFrame:
    return found.union(found.select(F.col("component").alias("node"), "component")).distinct()


@dataclass
class Components:
    """rows: (doc_id, tid, n, a), a naming the row's set; chosen: (a, of, first, first_tid), the row with the smallest
    (doc_id, tid) of all sets that are linked with a set."""

    rows: DataFrame
    chosen: DataFrame
    staging: Staging


def components(docs: DataFrame, text: str, width: int, num: int, den: int) -> Components:
    staging = Staging(docs.sparkSession, "jaccard")
    docs = docs.select("doc_id", F.xxhash64(F.col(text)).alias("tid"), F.col(text).alias("text"))
    # parts are random numbers: no dictionary, and small groups of rows, which writers hold in memory
    sets = staging.keep(_sets(docs, width, num, den), "sets", **{"parquet.enable.dictionary": "false", "parquet.block.size": 16 << 20})
    rows = sets.select("doc_id", "tid", "n", "a")
    unique = staging.keep(rows.where("n > 0 and doc_id is not null").groupBy("a").agg(F.min(F.struct("doc_id", "tid")).alias("first")), "unique")
    met = staging.keep(_met(sets, staging), "met")
    held = met.select("rep", "degree", F.explode("sigs").alias("sig"))
    top = held.groupBy("sig").agg(F.max(F.struct("degree", "rep")).alias("top"), F.count("*").alias("n")).where("n > 1").select("sig", F.col("top.rep").alias("v"))
    edges = held.select("sig", F.col("rep").alias("u")).join(top, "sig").select("u", "v").where("u <> v").distinct()
    families = staging.keep(_with_roots(connected_components(staging.keep(edges, "meetings"), staging)), "families")
    families = families.join(families.groupBy("component").agg(F.count("*").alias("size")), "component").select(F.col("node").alias("a"), F.col("component").alias("family"), "size")
    wanted = staging.keep(unique.join(families, "a").select("a", "family", "size", "first.doc_id", "first.tid"), "wanted")
    bits = filter_bits(wanted.count())
    near = may_hold(docs, "doc_id", membership_filter(wanted, "doc_id", bits), bits).where("_maybe").select("doc_id", "tid", "text")
    near = near.join(wanted, ["doc_id", "tid"]).groupBy("a", "family", "size").agg(F.min("text").alias("text"))
    blobs = _blobs(near.select(F.col("a").alias("rep"), "family", "size", "text"), width)
    blobs = staging.keep(blobs.withColumn("bytes", F.octet_length("blob").cast("long")), "blobs")
    found = staging.keep(_connected(blobs, met, num, den, staging), "components")
    linked_ = unique.join(found, unique["a"] == found["node"]).select("a", "component", "first")
    best = linked_.join(linked_.groupBy("component").agg(F.min("first").alias("best")), "component").select("a", "best")
    chosen = unique.join(best, "a", "left").select("a", F.coalesce("best", "first").alias("first")).select("a", "first.doc_id", F.col("first.tid").alias("first_tid"))
    return Components(rows, staging.keep(chosen.withColumnRenamed("doc_id", "first"), "chosen"), staging)


def jaccard_components(docs: DataFrame, text: str = "text", width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs: links are den * intersection >= num * union.

    Sets of ``width``-word shingles of whole texts; fewer words make one shingle, null and empty texts an empty set that
    links with nothing. component_id is the smallest doc_id reachable. Rows are nodes by their sets: rows that repeat a
    doc_id with the same text are one, with unlinked texts two, whose component_id may still be the same id. Rows with
    a null doc_id link with nothing and have a null component; an empty table gives none. Other columns are not read.
    The join is exact up to collisions of 64-bit hashes of shingles and of sets."""
    c = components(docs, text, width, num, den)
    rows = c.rows.join(c.chosen.select(F.col("a").alias("_a"), "first"), F.col("a") == F.col("_a"), "left")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("doc_id"))).alias("component_id"))
    kept = Staging(docs.sparkSession, "jaccard-result").keep(out, "result")
    c.staging.clear()
    return kept


def op10_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Components of all documents whose sets of three-word shingles have a Jaccard similarity of 0.9 or more."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=3, num=90, den=100)


def keep_one_of_each(spark, docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Pipeline stage: of each component of near copies (five-word shingles, similarity 0.8) one row stays, that with
    the smallest doc_id; of rows that repeat it, that with the smallest hash of its text, and of equal texts one.

    Rows without words and rows with a null doc_id stay, all of them; rows that repeat a doc_id with unlinked texts
    both stay. Columns may have any names. Only documents whose ids may be among those to drop are shuffled; a bounded
    filter lets the others pass."""
    c = components(docs, "text", width, num, den)
    staging = Staging(spark, "one-of-each")
    rows = c.rows.where("n > 0 and doc_id is not null").join(c.chosen.select(F.col("a").alias("_a"), "first", "first_tid"), F.col("a") == F.col("_a"))
    marked = rows.select("doc_id", "tid", ((F.col("doc_id") == F.col("first")) & (F.col("tid") == F.col("first_tid"))).alias("stays"))
    touched = staging.keep(marked.groupBy("doc_id", "tid").agg(F.bool_or("stays").alias("stays"), F.count("*").alias("times")).where("not stays or times > 1"), "touched")
    c.staging.clear()
    bits = filter_bits(touched.count())
    row = docs.select(F.struct(*columns_of(docs)).alias("row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_tid"), row_hash(docs).alias("_hash"))
    sure = may_hold(row, "_id", membership_filter(touched.select(F.col("doc_id").alias("_id")), "_id", bits), bits)
    doubtful = sure.where("_maybe").join(touched.select(F.col("doc_id").alias("_id"), F.col("tid").alias("_tid"), "stays"), ["_id", "_tid"], "left").where("coalesce(stays, true)")
    once = doubtful.where("stays").groupBy("_id", "_tid").agg(F.min_by("row", "_hash").alias("row")).select("row.*")
    return sure.where("not _maybe").select("row.*").union(doubtful.where("stays is null").select("row.*")).union(once)
