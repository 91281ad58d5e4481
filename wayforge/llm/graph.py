"""Connected components and bounded membership filters as Spark jobs."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayforge.llm.common import Staging

#: Least and most bits of a membership filter: its table has so many / 64 rows at most.
LEAST_BITS, MOST_BITS = 1 << 21, 1 << 25
#: Edges that a task contracts, about: a graph has so many partitions.
EDGES = 400_000


def _contract(batches):
    """Each node of a partition's edges with the smallest node that they connect it to; memory is that of the partition."""
    parent: dict[int, int] = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for i in range(0, len(nodes), 100_000):
        part = nodes[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["u", "v"])


def connected_components(edges: DataFrame, staging: Staging) -> DataFrame:
    """(node, component) for every node with an edge but the roots; edges: (u, v). The component is its smallest node.

    Each partition's edges are contracted, first where they are and then with all edges of a node in one partition, of
    which there are as many as the edges left need; and every edge jumps to its parent's smallest parent, until each node
    has one parent and no parent has one. With a single partition that is so at once. What a join reads was written, so
    that it shuffles both sides itself and a hub's edges can be split."""
    contracted = "u long, v long"
    now = staging.keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").mapInArrow(_contract, contracted), "edges")
    while True:
        tasks = now.count() // EDGES + 1
        own = staging.keep(now.select("u", "v").repartition("u").coalesce(tasks).mapInArrow(_contract, contracted), "contracted")
        staging.drop(now)
        if tasks == 1:
            return own.select(F.col("u").alias("node"), F.col("v").alias("component"))
        parents = staging.keep(own.groupBy("u").agg(F.min("v").alias("p"), F.count("*").alias("n")), "parents")
        jumped = own.join(parents.select(F.col("u").alias("v"), "p"), "v", "left").select("u", F.coalesce("p", "v").alias("v"), F.col("p").isNotNull().alias("moved"))
        # a node with several parents keeps them connected: each larger one gets an edge to the smallest
        several = own.join(parents.where("n > 1").select("u", "p"), "u").where("v <> p").select(F.col("v").alias("u"), F.col("p").alias("v"), F.lit(True).alias("moved"))
        now = staging.keep(jumped.union(several), "jumped")
        staging.drop(own, parents)
        if not now.where("moved").limit(1).count():
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def filter_bits(keys: int) -> int:
    """Bits for a filter of so many keys, eight a key within the bounds. Beyond four million keys it lets more rows pass
    and saves less; what passes is always joined exactly."""
    bits = LEAST_BITS
    while bits < min(8 * keys, MOST_BITS):
        bits *= 2
    return bits


def membership_filter(keys: DataFrame, key: str, bits: int = LEAST_BITS) -> DataFrame:
    """A one-hash Bloom filter of the keys as a table (_word, _bits) of bounded size."""
    hashed = keys.select(F.pmod(F.xxhash64(key), F.lit(bits)).alias("_b"))
    return hashed.groupBy((F.col("_b") / 64).cast("long").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_b % 64 as int))")).alias("_bits"))


def may_hold(df: DataFrame, key: str, filter_: DataFrame, bits: int = LEAST_BITS) -> DataFrame:
    """df with ``_maybe``: false where the key surely was not among the filter's keys."""
    bit = F.pmod(F.xxhash64(key), F.lit(bits))
    joined = df.withColumn("_word", (bit / 64).cast("long")).join(F.broadcast(filter_), "_word", "left")  # at most bits / 64 rows
    hit = F.expr(f"shiftright(_bits, cast(pmod(xxhash64({key}), {bits}) % 64 as int)) & 1L")
    return joined.withColumn("_maybe", F.coalesce(hit == 1, F.lit(False))).drop("_word", "_bits")
