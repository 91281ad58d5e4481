"""Resharding by minimum-cost flow: from old shard sizes to new capacities with the fewest bytes moved."""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayforge.llm.common import Staging, columns_of, row_hash

#: Blocks of a size class in an old shard: at most this many, so that the table of blocks is bounded.
MAX_SUBS = 1 << 16
ROWS_A_SUB = 1000
#: Rows of a shard that go to one file.
ROWS_A_FILE = 25_000


def min_cost_transfers(sizes: dict[int, int], capacities: dict[int, int], cost=None) -> list[tuple[int, int, int]]:
    """(old, new, bytes) that ship all bytes at the least cost.

    cost(old, new) is per byte. Without one it is 0 where the names are equal, else 1, and a flow of least cost is known:
    each shard keeps as much as fits, which no flow exceeds, and what is left fills the free capacities in order, in
    time and memory of the number of shards. Other costs are solved by successive shortest paths over all pairs, for
    shards counted in hundreds. The capacities must hold all bytes."""
    olds, news = sorted(sizes), sorted(capacities)
    if sum(sizes.values()) > sum(capacities.values()):
        raise ValueError("the capacities are too small")
    left, room = dict(sizes), dict(capacities)
    flow: dict[tuple[int, int], int] = {}
    if cost is None:
        for k in sizes.keys() & capacities.keys():
            flow[k, k] = kept = min(sizes[k], capacities[k])
            left[k], room[k] = left[k] - kept, room[k] - kept
        free = iter([b for b in news if room[b]])
        b = next(free, None)
        for a in olds:
            while left[a]:
                amount = min(left[a], room[b])
                flow[a, b] = flow.get((a, b), 0) + amount
                left[a], room[b] = left[a] - amount, room[b] - amount
                if not room[b]:
                    b = next(free, None)
    while any(left.values()):
        # nodes: ("o", a), ("n", b); forward edges always, backward edges where there is flow
        far = {("o", a): 0 for a in olds if left[a]}
        back: dict = {}
        queue = deque(far)
        waiting = set(queue)
        while queue:
            u = queue.popleft()
            waiting.discard(u)
            kind, x = u
            nexts = [(("n", b), cost(x, b)) for b in news] if kind == "o" else [(("o", a), -cost(a, x)) for a in olds if flow.get((a, x))]
            for v, c in nexts:
                if v not in far or far[u] + c < far[v]:
                    far[v], back[v] = far[u] + c, u
                    if v not in waiting:
                        waiting.add(v)
                        queue.append(v)
        end = min((("n", b) for b in news if room[b] and ("n", b) in far), key=lambda v: (far[v], v[1]))
        path, v = [], end
        while v in back:
            path.append((back[v], v))
            v = back[v]
        amount = min([left[v[1]], room[end[1]], *(flow[(y[1], x[1])] for x, y in path if x[0] == "n")])
        for x, y in path:
            if x[0] == "o":
                flow[(x[1], y[1])] = flow.get((x[1], y[1]), 0) + amount
            else:
                flow[(y[1], x[1])] -= amount
        left[v[1]] -= amount
        room[end[1]] -= amount
    return sorted((a, b, n) for (a, b), n in flow.items() if n)


def equal_capacities(total: int, shards: int) -> dict[int, int]:
    return {k: total // shards + (k < total % shards) for k in range(shards)}


def _place(size: Column, hashed: Column, n: int) -> tuple[Column, Column]:
    """Class and part of a row of n rows, by which an old shard is laid out."""
    return F.floor(F.log2(size + 1)).cast("int"), F.pmod(hashed, F.lit(max(1, min(MAX_SUBS, n // ROWS_A_SUB)))).cast("int")


def reshard(rows: DataFrame, capacities: dict[int, int] | int, cost=None, key: str | None = None) -> DataFrame:
    """rows (any columns, among them ``size`` long and ``old_shard`` int) with ``shard`` and ``slot``.

    Sizes of the old shards and of their blocks are summed, the flow is solved on the shards alone, and its transfers
    become byte ranges of every old shard: what stays comes first, and an old shard's rows are laid out from the
    largest class of sizes (by powers of two) to the smallest, so a range ends among small rows. capacities may be a
    number of shards of equal sizes. Rows are placed by the middle of their own range; a shard differs from its capacity by
    a few small rows. slot counts from 0 in each shard without gaps. A null old_shard counts as -1 and a null size as
    0; repeated rows each get a slot; an empty table gives no rows. A column named shard or slot is replaced; others may
    have any names. Rows of equal sizes are taken by a hash of the row, which also breaks ties, or
    by key, a column without nulls or repeats; then ``rewrite_files`` can tell a row's shard without its placement."""
    spark = rows.sparkSession
    staging = Staging(spark, "reshard")
    rows = rows.drop("shard", "slot")
    n = rows.count()
    size, tie = F.coalesce("size", F.lit(0)).cast("long"), F.col(key) if key else row_hash(rows)
    keyed = rows.select(F.struct(*columns_of(rows)).alias("_row"), F.coalesce("old_shard", F.lit(-1)).alias("_old"), size.alias("_size"), tie.alias("_tie"))
    classed = _place(F.col("_size"), F.xxhash64("_tie") if key else F.col("_tie"), n)
    keyed = keyed.withColumns(dict(zip(("_class", "_sub"), classed)))
    keyed = staging.keep(keyed, "keyed")
    block = ["_old", "_class", "_sub"]
    blocks = keyed.groupBy(*block).agg(F.sum("_size").alias("_bytes"))
    sizes = {r["_old"]: r["b"] for r in keyed.groupBy("_old").agg(F.sum("_size").alias("b")).collect()}
    if isinstance(capacities, int):
        capacities = equal_capacities(sum(sizes.values()), capacities)
    transfers, ranges = min_cost_transfers(sizes, capacities, cost), []
    for old in sorted(sizes):
        at, own = 0, [(b, k) for a, b, k in transfers if a == old] or [(old if old in capacities else min(capacities), 0)]
        for new, amount in sorted(own, key=lambda m: (m[0] != old, m[0])):
            ranges.append((old, new, at, at + amount))
            at += amount
        ranges[-1] = (*ranges[-1][:3], 1 << 62)  # rows of size 0 come last
    cuts = F.broadcast(spark.createDataFrame(ranges or [(0, 0, 0, 0)], "_old int, shard int, _from long, _to long"))
    before = Window.partitionBy("_old").orderBy(F.desc("_class"), "_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_start", F.coalesce(F.sum("_bytes").over(before), F.lit(0))).drop("_bytes")
    inside = Window.partitionBy(*block).orderBy("_tie")
    placed = keyed.withColumns({"_cum": F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)), "_rn": F.row_number().over(inside)})
    placed = placed.join(offsets, block).withColumn("_at", F.col("_start") + F.col("_cum") - F.expr("_size - _size div 2"))
    placed = placed.join(cuts, "_old").where("_at >= _from and _at < _to")
    placed = staging.keep(placed.select("_row", *block, "shard", "_rn"), "placed")
    staging.drop(keyed)
    parts = placed.groupBy("shard", *block).agg(F.count("*").alias("_n"), F.min("_rn").alias("_first"))
    ahead = Window.partitionBy("shard").orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_first")).drop("_n", "_first")
    return placed.join(parts, ["shard", *block]).select("_row.*", "shard", (F.col("_ahead") + F.col("_rn")).cast("long").alias("slot"))


def _touched(placed: DataFrame) -> DataFrame:
    """Shards that lost or got rows."""
    moved = placed.where("not (old_shard <=> shard)")
    return moved.select(F.explode(F.array("old_shard", "shard")).alias("shard")).where("shard is not null").distinct()


def _paths(placed: DataFrame, touched: DataFrame, old_root: str, new_root: str) -> DataFrame:
    mark = touched.withColumn("rewritten", F.lit(True))
    out = placed.select("shard").distinct().join(mark, "shard", "left").withColumn("rewritten", F.coalesce("rewritten", F.lit(False)))
    return out.select("shard", F.concat(F.when(F.col("rewritten"), F.lit(new_root)).otherwise(F.lit(old_root)), F.lit("/shard="), F.col("shard").cast("string")).alias("path"), "rewritten")


def rewrite_affected(placed: DataFrame, old_root: str, new_root: str) -> DataFrame:
    """Writes the shards whose rows changed to new_root/shard=K; returns (shard, path, rewritten) for all shards.

    placed has old_shard and shard beside the data. A shard that neither lost nor got rows keeps its files in
    old_root/shard=K. Nothing is deleted: readers switch by the returned table."""
    touched = _touched(placed)
    placed.join(F.broadcast(touched), "shard").write.mode("overwrite").partitionBy("shard").parquet(new_root)
    return _paths(placed, touched, old_root, new_root)


def rewrite_files(placed: DataFrame, old_root: str, new_root: str, schema, key: str, size: Column) -> DataFrame:
    """As ``rewrite_affected``, but the data are read from old_root, whose files hold key and have the schema (with shard).

    placed comes from ``reshard`` by the same key: key, old_shard (no nulls), size and shard. size tells the size of a row of
    the files. What an old shard ships to a new one is a stretch of its layout, so the first row of each stretch, at
    most a table of old and new shards, says where a row goes: the data meet no placement and travel once, to the
    files of their shard, which hold about ROWS_A_FILE rows. A changed shard gets its rows only from changed shards, so the
    files of others are not read. An empty table gives no files."""
    n = placed.count()
    touched = _touched(placed)
    ordered = lambda size: F.struct((-(c := _place(size, F.xxhash64(key), n))[0]).alias("a"), c[1].alias("b"), F.col(key).alias("c"))
    first = placed.groupBy("old_shard", "shard").agg(F.min(ordered(F.col("size"))).alias("_from"), F.count("*").alias("_n"))
    first = first.withColumn("_to", F.lead("_from").over(Window.partitionBy("old_shard").orderBy("_from")))
    first = first.withColumn("_files", F.ceil(F.sum("_n").over(Window.partitionBy("shard")) / ROWS_A_FILE))
    stretches = F.broadcast(first.select(F.col("old_shard").alias("_old"), F.col("shard").alias("_new"), "_from", "_to", "_files"))
    data = placed.sparkSession.read.schema(schema).parquet(old_root).join(F.broadcast(touched), "shard").withColumn("_at", ordered(size))
    data = data.join(stretches, (F.col("shard") == F.col("_old")) & (F.col("_at") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("_at") < F.col("_to"))))
    rows = data.repartition("_new", F.pmod(F.xxhash64(key), F.col("_files"))).drop("shard", "_old", "_at", "_from", "_to", "_files").withColumnRenamed("_new", "shard")
    rows.write.mode("overwrite").partitionBy("shard").option("compression", "zstd").parquet(new_root)
    return _paths(placed, touched, old_root, new_root)


def read_shards(files: DataFrame, old_root: str, new_root: str, schema) -> DataFrame:
    """The rows of all shards after ``rewrite_files``: changed shards from new_root, all others from old_root."""
    old, new = (files.sparkSession.read.schema(schema).parquet(root) for root in (old_root, new_root))
    kept = old.join(F.broadcast(files.where("not rewritten").select("shard")), "shard")  # at most a row for each shard
    return kept.unionByName(new)


def digest(text: str) -> tuple[Column, Column]:
    """size: bytes of the text in UTF-8 and 8; text_crc32: its checksum; a null text has no bytes."""
    data = F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))
    return (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32")


def old_shard() -> Column:
    """The old layout of documents: sixteen shards, two to every group of sources."""
    return (F.pmod(F.xxhash64("source"), F.lit(8)) * 2 + F.pmod(F.xxhash64("doc_id"), F.lit(2))).cast("int")


def layout(docs: DataFrame) -> DataFrame:
    """The digest columns and the old shard of documents."""
    return docs.select("doc_id", *digest("text"), old_shard().alias("old_shard"))


def by_contract(placed: DataFrame) -> DataFrame:
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def rewrite_documents(spark, docs: DataFrame, shards: int = 24) -> DataFrame:
    """docs laid out as files of their old shards, resharded, changed files rewritten, and the files read back.

    Sizes and checksums are those of the texts in the files after the move, and a row counts for the shard whose folder it
    lies in: a row that the move lost, doubled or changed would show. Null ids and texts stay null, repeated rows are files'
    rows of their own, an empty table gives no rows; other columns are not carried."""
    staging = Staging(spark, "shards")
    old_root, new_root = staging.path("old"), staging.path("new")
    # written once, so a row keeps its number whatever is computed again
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", old_shard().alias("shard"))
    numbered.write.partitionBy("shard").option("compression", "zstd").parquet(old_root)
    old = spark.read.schema(numbered.schema).parquet(old_root).select("row", F.col("shard").alias("old_shard"), digest("text")[0])
    placed = staging.keep(reshard(old, shards, key="row"), "placed")
    files = staging.keep(rewrite_files(placed, old_root, new_root, numbered.schema, "row", digest("text")[0]), "files")
    rows = read_shards(files, old_root, new_root, numbered.schema).select("row", "doc_id", *digest("text"), "shard")
    return rows.join(placed.drop("size"), ["row", "shard"]).drop("row")


def op2_resharding(spark, sf_dir: str) -> DataFrame:
    """All documents into 24 shards of nearly equal bytes, moving the fewest bytes from sixteen old ones, as files."""
    return by_contract(rewrite_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")))


def shard_documents(spark, docs: DataFrame, shards: int = 24) -> DataFrame:
    """Pipeline stage: the placement of the documents; what follows it writes them."""
    return by_contract(reshard(layout(docs), shards))
