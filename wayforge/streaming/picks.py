"""Change events of shared picks as streams: last write wins, merges by field, echoes, rollback, admission, watch mode.

A stream's output goes to one folder a batch, which a repeated batch writes anew; the newest state of a key is that of
its last batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from wayforge.session import work_path


def _run(stream: DataFrame, mode: str, root: str) -> None:
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/epoch={epoch}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()


def _drained(stream: DataFrame, root: str) -> DataFrame:
    return stream.sparkSession.read.schema(StructType([*stream.schema.fields, StructField("epoch", IntegerType())])).parquet(f"{root}/rows")


def arrivals(table: DataFrame, at: str, batches: int = 3) -> list[DataFrame]:
    """The table in so many parts in order of time, about equally large."""
    cuts = table.agg(F.percentile_approx(at, [i / batches for i in range(1, batches)])).first()[0] or []
    edges = [None, *cuts, None]
    after = lambda x: F.lit(True) if x is None else F.col(at) > x
    until = lambda x: F.lit(True) if x is None else F.col(at) <= x
    return [table.where(after(x) & until(y)) for x, y in zip(edges[:-1], edges[1:])]


def drain_arrivals(parts: list[DataFrame], plan: Callable[[DataFrame], DataFrame], mode: str, name: str) -> DataFrame:
    """Each part arrives in a folder and is then a micro-batch of plan's stream, whose state goes on; rows with ``epoch``."""
    spark = parts[0].sparkSession
    root = work_path(spark, name)
    for part in parts:
        part.write.mode("append").parquet(f"{root}/source")
        stream = plan(spark.readStream.schema(part.schema).parquet(f"{root}/source"))
        _run(stream, mode, root)
    return _drained(stream, root)


def newest(rows: DataFrame, key: list[str]) -> DataFrame:
    """The last emitted state of each key."""
    others = [c for c in rows.columns if c not in (*key, "epoch")]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*others), "epoch").alias("_s")).select(*key, "_s.*")


def last_write_wins(changes: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key: an older change never replaces a newer one. For streams and tables alike."""
    others = [c for c in changes.columns if c not in key]
    return changes.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_s")).select(*key, "_s.*")


def merge_fields(edits: DataFrame, key: list[str], fields: list[str], seq: str) -> DataFrame:
    """The newest value of each field by its own sequence; an edit touches the fields that are not null."""
    last = [F.max_by(f, F.when(F.col(f).isNotNull(), F.col(seq))).alias(f) for f in fields]
    seqs = [F.max(F.when(F.col(f).isNotNull(), F.col(seq))).alias(f"{f}_seq") for f in fields]
    return edits.groupBy(*key).agg(*last, *seqs)


def overlay(stored: DataFrame, pending: DataFrame, key: list[str], fields: list[str], watermark: Column) -> DataFrame:
    """Stored rows with the pending fields whose sequence is above the watermark."""
    p = pending.select(*key, *(F.struct(F.col(f).alias("v"), F.col(f"{f}_seq").alias("s")).alias(f"_{f}") for f in fields))
    out = stored.join(p, key, "left")
    return out.select(*key, *(F.when(F.col(f"_{f}.s") > watermark, F.col(f"_{f}.v")).otherwise(F.col(f)).alias(f) for f in fields))


def without_echoes(events: DataFrame, id_: str, at: str, delay: str = "1 day") -> DataFrame:
    """Each event id once; ids are remembered for the delay."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).dropDuplicatesWithinWatermark([id_])


STATE = "confirmed long, ids array<long>, pending array<long>"
VISIBLE = "key long, confirmed long, visible long, waiting long"


def _edits(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Each edit waits under its id until it is confirmed or fails, which touches it alone; an id that is not waiting (an
    echo that comes twice, a failure after a confirmation) changes nothing."""
    confirmed, ids, values = state.get if state.exists else (None, [], [])
    waiting = dict(zip(ids, values))
    for kind, mutation, value in pd.concat(list(frames)).sort_values(["ts", "event_id"])[["kind", "mutation", "value"]].itertuples(index=False):
        if kind == "edit":
            waiting[int(mutation)] = int(value)
        elif pd.notna(mutation) and int(mutation) in waiting:
            value = waiting.pop(int(mutation))
            if kind == "confirm":
                confirmed = value
    state.update((confirmed, list(waiting), list(waiting.values())))
    visible = next(reversed(waiting.values())) if waiting else confirmed
    yield pd.DataFrame({"key": [key[0]], "confirmed": pd.array([confirmed], dtype="Int64"), "visible": pd.array([visible], dtype="Int64"), "waiting": [len(waiting)]})


def rollback(events: DataFrame) -> DataFrame:
    """(key, confirmed, visible, waiting) from events (key, kind edit, confirm or fail, mutation, value, ts, event_id).

    A failed edit goes alone, newer ones stay visible; when none waits any more, the last confirmed value is shown. The
    state of a key holds its waiting edits."""
    return events.groupBy("key").applyInPandasWithState(_edits, VISIBLE, STATE, "update", "NoTimeout")


def review_states(reviews: DataFrame, now: DataFrame, group: str) -> DataFrame:
    """reviews (a stream or a table with group and seen, the digest that was reviewed) with ``state`` against the current
    digests (group, digest): never, reviewed or again."""
    state = F.when(F.col("seen").isNull(), "never").when(F.col("seen") == F.col("digest"), "reviewed").otherwise("again")
    return reviews.join(now.select(group, "digest"), group, "left").withColumn("state", state).drop("digest")


def admitted(changes: DataFrame, members: DataFrame, admins: DataFrame, owners: DataFrame) -> DataFrame:
    """changes (id, writer, owner, place) with ``verdict``.

    A member writes own rows unless an admin; an admin writes rows of members; the owner and place of an id never change. All
    sides are tables of people, joined as they are."""
    m = members.select(F.col("user_id").alias("writer"), F.lit(True).alias("_member"))
    a = admins.select(F.col("user_id").alias("writer"), F.lit(True).alias("_admin"))
    o = members.select(F.col("user_id").alias("owner"), F.lit(True).alias("_owner_member"))
    known = owners.select("id", F.col("owner").alias("_owner"), F.col("place").alias("_place"))
    out = changes.join(m, "writer", "left").join(a, "writer", "left").join(o, "owner", "left").join(known, "id", "left")
    moved = F.col("_owner").isNotNull() & ((F.col("_owner") != F.col("owner")) | (F.col("_place") != F.col("place")))
    verdict = (
        F.when(moved, "identity").when(F.col("_admin") & F.col("_owner_member"), "ok").when(F.col("_admin"), "not-a-member")
        .when(F.col("_member") & (F.col("writer") == F.col("owner")), "ok").when(F.col("_member"), "not-own").otherwise("no-member")
    )
    return out.select("id", "writer", "owner", "place", verdict.alias("verdict"))


def watch(parts: list[DataFrame], work: Callable[[DataFrame], DataFrame], key: str, hash_: str, order: str, name: str) -> DataFrame:
    """Repeats the incremental cycle on each part that arrives: only keys that are new, or whose newest hash (by order)
    changed, are worked on. Results have ``at``, the batch.

    The stored hashes are one table a batch, made of the last one's and the batch's, so a batch reads one table; the
    one before the last is deleted."""
    from wayforge.operators.worksets import stale_keys

    spark = parts[0].sparkSession
    root = work_path(spark, name)

    def step(batch: DataFrame, epoch: int) -> None:
        current = batch.groupBy(key).agg(F.max_by(hash_, order).alias(hash_))
        if epoch:
            stored = spark.read.parquet(f"{root}/stored/epoch={epoch - 1}")
            todo = current.join(stale_keys(current, stored, key, hash_).select(key), key, "left_semi")
            then = stored.join(current, key, "left_anti").unionByName(current)
        else:
            todo = then = current
        work(todo).withColumn("at", F.lit(epoch)).write.mode("overwrite").parquet(f"{root}/done/epoch={epoch}")
        then.write.mode("overwrite").parquet(f"{root}/stored/epoch={epoch}")
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/stored/epoch={epoch - 2}")
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    for part in parts:
        part.write.mode("append").parquet(f"{root}/source")
        stream = spark.readStream.schema(part.schema).parquet(f"{root}/source")
        stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).foreachBatch(step).start().awaitTermination()
    return spark.read.parquet(f"{root}/done")


def votes_kept(state: DataFrame) -> DataFrame:
    """Votes after toggling: the same rating twice in a row clears it, and rows with nothing but defaults go."""
    w = Window.partitionBy("user_id", "place").orderBy("ts", "event_id")
    change = state.withColumn("_last", F.lag("rating").over(w)).withColumn("_n", F.row_number().over(w))
    # runs of the same rating: an even run clears, an odd one sets
    run = change.withColumn("_run", F.sum(F.when(F.col("rating") == F.col("_last"), 0).otherwise(1)).over(w))
    size = run.groupBy("user_id", "place", "_run").agg(F.count("*").alias("k"), F.max("rating").alias("rating"))
    last = size.groupBy("user_id", "place").agg(F.max_by(F.struct("rating", "k"), "_run").alias("s"))
    return last.select("user_id", "place", F.when(F.col("s.k") % 2 == 1, F.col("s.rating")).otherwise(0).alias("rating")).where("rating <> 0")
