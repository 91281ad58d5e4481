"""Near-duplicate fingerprints by meet-in-the-middle ball hashing.

A text's fingerprint is the majority, bit by bit, of the hashes of its shingles. Two fingerprints within a radius share a
variant within half of it from each, so every distinct fingerprint emits all variants of its ball of half the radius,
and all that meet in one variant are linked. Variants are shuffled by their leading bits: those of one fingerprint that
share these travel as one row, which says how many flips are left, and the task that gets it writes out the rest of the
ball. A slice of leading bits that would hold too many variants is cut by more bits, as often as needed.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayforge.llm.common import LOWER, Staging, as_bytes, small
from wayforge.llm.graph import connected_components

BITS = 64
#: Variants of a slice, about and at most; a slice beyond is cut by so many further bits.
SLICE, MOST_VARIANTS, FURTHER = 250_000, 4_000_000, 6
#: Shingles whose bits are summed at once.
SUMMED = 1 << 14


def fingerprint(words: list[bytes], width: int, seed: int) -> int:
    """Bits that more than half of the shingles' hashes have; of fewer words the whole sequence is one shingle."""
    if not words:
        return 0
    width = min(width, len(words))
    data = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.r_[0, ends[:-1]].tolist()[: len(words) - width + 1]
    ends = (ends - 1).tolist()[width - 1 :]
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter([hashed(data[a:b], seed) for a, b in zip(starts, ends)], np.uint64, len(ends))
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(h), SUMMED):
        part = h[i : i + SUMMED].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h)).view(">u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp) for each row: fp is a long of the 64 bits; texts without words have 0. Words are runs without ASCII
    white space, A-Z taken as a-z; hashes are XXH64 of a shingle's words with one space between them."""

    def run(batches):
        for batch in small(batches, 200):
            found = np.asarray([fingerprint(t.translate(LOWER).split(), width, seed) for t in as_bytes(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64), pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def ball_size(bits: int, flips: int) -> int:
    """Variants of so many bits with at most so many flips."""
    total = row = 1
    for k in range(1, flips + 1):
        row = row * (bits - k + 1) // k
        total += row
    return total


@functools.cache
def ball(bits: int, flips: int) -> np.ndarray:
    """The masks of at most so many flips among the low bits, by the number of flips."""
    masks = [sum(1 << b for b in c) for k in range(flips + 1) for c in combinations(range(bits), k)] if bits else [0]
    return np.asarray(masks, np.uint64)


def slices_of(rows: DataFrame, depth: int, further: int, half: int) -> DataFrame:
    """rows (fp, slice, flips, ...), flips being those left after the first ``depth`` bits, cut by ``further`` bits: a row for
    each way to flip some of these. slice holds the leading bits of the variants."""
    ways = [(sum(1 << b for b in c), k) for k in range(min(half, further) + 1) for c in combinations(range(further), k)]
    way = F.explode(F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(k).alias("used")) for m, k in ways)))
    own = F.expr(f"shiftrightunsigned(fp, {(BITS - depth - further) % BITS}) & {(1 << further) - 1}L")
    cut = rows.withColumn("_way", way).where("_way.used <= flips")
    others = [c for c in rows.columns if c not in ("fp", "slice", "flips")]
    return cut.select("fp", F.shiftleft("slice", further).bitwiseOR(own.bitwiseXOR(F.col("_way.mask"))).alias("slice"), (F.col("flips") - F.col("_way.used")).alias("flips"), *others)


def spanning(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of n nodes is connected with by the edges."""
    label = np.arange(n)
    while len(u):
        a, b = label[u], label[v]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[u] != label[v]
        u, v = u[open_], v[open_]
    return label


def _meet(group: pd.DataFrame, depth: int, radius: int) -> pd.DataFrame:
    """Links of the fingerprints of a slice, enough to connect all that meet in a variant.

    Two that meet in a variant by at most radius // 2 and half flips are within the radius, so one such holder links all."""
    half, low = -(-radius // 2), BITS - depth
    fps, left = group["fp"].to_numpy(np.int64).view(np.uint64), group["flips"].to_numpy()
    tail = fps & np.uint64((1 << low) - 1)
    values, parts = [], []
    for flips in range(half + 1):
        at = np.flatnonzero(left == flips)
        masks = ball(low, min(flips, low))
        values.append((tail[at][:, None] ^ masks[None, :]).ravel())
        parts.append((at, np.bitwise_count(masks).astype(np.int64) + half - flips))
    v = np.concatenate(values)
    ranked = np.sort(v)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    none = pd.DataFrame({"u": pd.Series(dtype="int64"), "v": pd.Series(dtype="int64")})
    if not len(twice):
        return none
    met, owner, used = [], [], []
    for own, (at, flips) in zip(values, parts):
        place = np.minimum(np.searchsorted(twice, own), len(twice) - 1)
        hit = np.flatnonzero(twice[place] == own)
        met.append(place[hit])
        owner.append(at[hit // len(flips)])
        used.append(flips[hit % len(flips)])
    met, owner, used = np.concatenate(met), np.concatenate(owner), np.concatenate(used)
    by = np.lexsort((owner, used, met))
    met, owner, used = met[by], owner[by], used[by]
    first = np.maximum.accumulate(np.where(np.r_[True, met[1:] != met[:-1]], np.arange(len(met)), 0))
    pairs = np.unique(np.stack([owner, owner[first]], 1)[(used[first] <= radius // 2) & (owner != owner[first])], axis=0)
    pairs = pairs[np.bitwise_count(fps[pairs[:, 0]] ^ fps[pairs[:, 1]]) <= radius]
    label = spanning(pairs[:, 0], pairs[:, 1], len(fps))
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return pd.DataFrame({"u": fps[moved].view(np.int64), "v": fps[label[moved]].view(np.int64)})


def near_links(fps: DataFrame, radius: int, staging: Staging, slice_size: int = SLICE, most: int = MOST_VARIANTS) -> DataFrame:
    """(u, v): links between distinct fingerprints (fp), enough to connect all within the radius.

    The first cut has so many bits that a slice has about slice_size variants; slices of over ``most`` are cut again. In
    the end a slice is one variant, whose holders are in one ball, so every group of near copies is cut small enough."""
    half = -(-radius // 2)
    fps = staging.keep(fps.select("fp").distinct(), "distinct")
    depth, further = 0, max(0, int(np.ceil(np.log2(max(fps.count() * ball_size(BITS, half) / slice_size, 1)))))
    rows, links = fps.select("fp", F.lit(0).cast("long").alias("slice"), F.lit(half).alias("flips")), []
    while True:
        to = min(BITS, depth + further)
        # rows of equal leading bits are counted before they are cut
        head = F.expr(f"fp & {-1 << (BITS - to)}L") if to else F.lit(0).cast("long")
        counts = rows.groupBy(head.alias("fp"), "slice", "flips").agg(F.count("*").alias("n"))
        variants = F.element_at(F.array(*(F.lit(ball_size(BITS - to, min(k, BITS - to))).cast("long") for k in range(half + 1))), F.col("flips") + 1)
        large = slices_of(counts, depth, to - depth, half).groupBy("slice").agg(F.sum(F.col("n") * variants).alias("variants"))
        large = staging.keep(large.where((F.col("variants") > most) & F.lit(to < BITS)).select("slice"), "large")
        rows = slices_of(rows, depth, to - depth, half)
        meet = lambda r, d=to: r.groupBy("slice").applyInPandas(functools.partial(_meet, depth=d, radius=radius), "u long, v long")
        if not large.limit(1).count():
            links.append(meet(rows))
            return staging.keep(functools.reduce(DataFrame.union, links), "links")
        links.append(staging.keep(meet(rows.join(large, "slice", "left_anti")), "links"))
        rows = staging.keep(rows.join(large, "slice", "left_semi").select("fp", "slice", "flips"), "cut-again")
        depth, further = to, FURTHER


def simhash_components(docs: DataFrame, text: str = "text", radius: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs: rows link whose fingerprints differ in at most ``radius`` bits.

    Texts without words, nulls among them, have the fingerprint 0 and are linked like any other. component_id is the
    smallest doc_id reachable. Rows that repeat an id each have their own fingerprint and may have two components; rows
    with a null id link with nothing and have a null component; an empty table gives none. Bytes that are not UTF-8 are
    words like others. Other columns are not read. All links are found: see near_links."""
    staging = Staging(docs.sparkSession, "simhash")
    rows = staging.keep(fingerprints(docs, text, width, seed), "fingerprints")
    unique = staging.keep(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first")), "unique")
    found = staging.keep(connected_components(near_links(unique, radius, staging), staging), "components")
    named = found.union(found.select(F.col("component").alias("node"), "component").distinct())
    of = named.join(unique, F.col("node") == F.col("fp")).select("fp", "component", "first")
    best = of.join(of.groupBy("component").agg(F.min("first").alias("best")), "component").select("fp", "best")
    chosen = staging.keep(unique.join(best, "fp", "left").select("fp", F.coalesce("best", "first").alias("component_id")), "chosen")
    out = rows.join(chosen, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    kept = Staging(docs.sparkSession, "simhash-result").keep(out, "result")
    staging.clear()
    return kept


def op12_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their components within four bits."""
    found = simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
