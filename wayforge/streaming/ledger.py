"""State behind a stream of edits: a snapshot table that changes are replayed onto, pending edits by field, toggled votes."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from wayforge.operators import commits
from wayforge.session import work_path
from wayforge.streaming.picks import last_write_wins

# -- a snapshot, then the changes ------------------------------------------------------------------------------------


class ReplayedTable:
    """A table of the newest row of each key, made of a snapshot and of the changes of a stream.

    Changes that arrive before the snapshot wait in files, one folder an epoch; ``load`` merges the snapshot with them,
    and later epochs merge as they come. Rows lie in buckets by key; a merge writes the buckets that it touches and
    commits a version that names each bucket's files, with the last epoch applied. A repeated epoch changes nothing, an
    older change never replaces a newer one, and a merge that dies before its commit leaves no trace to readers."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: list[str], seq: str, buckets: int = 16):
        self.spark, self.root, self.schema, self.key, self.seq, self.buckets = spark, root, schema, key, seq, buckets

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names, F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int").alias("bucket"))

    def _merge(self, rows: DataFrame, epoch: int) -> None:
        now = commits.latest(self.spark, self.root) or {"version": -1, "paths": {}, "epoch": -1}
        own = self._bucketed(rows)
        touched = [str(r["bucket"]) for r in own.select("bucket").distinct().collect()]  # at most so many as there are buckets
        old = [f"{self.root}/{now['paths'][b]}" for b in touched if b in now["paths"]]
        if old:
            own = own.unionByName(self._bucketed(self.spark.read.schema(self.schema).parquet(*old)))
        version, paths = now["version"] + 1, dict(now["paths"])
        folder = f"data/version={version}-epoch={epoch}"
        merged = last_write_wins(own, [*self.key, "bucket"], [self.seq]).select(*self.schema.names, "bucket")
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{folder}")
        paths |= {b: f"{folder}/bucket={b}" for b in touched}
        if not commits.commit(self.spark, self.root, version, {"paths": paths, "epoch": max(epoch, now["epoch"])}):
            raise RuntimeError(f"another writer has made version {version}")
        commits.recover(self.spark, self.root)

    def arrive(self, batch: DataFrame, epoch: int) -> None:
        """For foreachBatch: applies an epoch's changes, or keeps them until the snapshot is there."""
        now = commits.latest(self.spark, self.root)
        if now is None:
            batch.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.root}/waiting/epoch={epoch}")
        elif epoch > now["epoch"]:
            self._merge(batch, epoch)

    def load(self, snapshot: DataFrame) -> None:
        """Takes the snapshot, whose rows count as older than any change if they have no sequence, and replays what waits."""
        if commits.latest(self.spark, self.root) is not None:
            raise ValueError("the table has its snapshot already")
        rows = snapshot if self.seq in snapshot.columns else snapshot.withColumn(self.seq, F.lit(None).cast(self.schema[self.seq].dataType))
        rows = rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema.fields))
        waiting = commits.names(self.spark, f"{self.root}/waiting")
        epochs = [int(n.removeprefix("epoch=")) for n in waiting]
        if epochs:
            rows = rows.unionByName(self.spark.read.schema(self.schema).parquet(*(f"{self.root}/waiting/{n}" for n in waiting)))
        self._merge(rows, max(epochs, default=-1))
        commits.delete(self.spark, f"{self.root}/waiting")

    def rows(self) -> DataFrame:
        """The table as of the current version."""
        now = commits.latest(self.spark, self.root)
        paths = [f"{self.root}/{p}" for p in now["paths"].values()] if now else []
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)


def replay_arrivals(parts: list[DataFrame], snapshot: DataFrame, key: list[str], seq: str, name: str, loaded_after: int = 1) -> DataFrame:
    """Changes that arrive part by part, of which the snapshot comes after the first ``loaded_after``; the table at the end."""
    spark = parts[0].sparkSession
    root = work_path(spark, name)
    table = ReplayedTable(spark, f"{root}/table", parts[0].schema, key, seq)
    for i, part in enumerate(parts):
        if i == loaded_after:
            table.load(snapshot)
        part.write.mode("append").parquet(f"{root}/source")
        stream = spark.readStream.schema(part.schema).parquet(f"{root}/source")
        stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).foreachBatch(table.arrive).start().awaitTermination()
    if loaded_after >= len(parts):
        table.load(snapshot)
    return table.rows()


# -- stateful processors ---------------------------------------------------------------------------------------------

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def keyed_state(spark: SparkSession):
    """State variables by name need the RocksDB store; queries started inside have it."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def in_order(frames: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(frames)).sort_values(order)


ENTRY = "struct<seq:bigint,value:string,settled:boolean>"


class PendingFields(StatefulProcessor):
    """The edits of a row's fields that are not confirmed yet, field by field, and the value last confirmed.

    Events, in order of (at, id): ``edit`` (field, seq, value) is shown at once; ``settle`` (field, seq) confirms an edit,
    which stays behind to meet its echo as long as a newer one waits; ``fail`` (field, seq) takes an edit back alone;
    ``echo`` (field, value) is a row that comes back: if it is an own edit's value, that edit is done, else somebody
    else's value is confirmed; ``response`` (field, seq, value) is an answer to a request that knew the edits up to seq: only
    newer ones override it. Edits wait for an answer however long it takes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.fields = handle.getMapState("fields", "field string", f"confirmed string, known bigint, waiting array<{ENTRY}>")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:
        touched: dict[str, tuple] = {}
        for kind, field, seq, value in in_order(rows, ["at", "id"])[["kind", "field", "seq", "value"]].itertuples(index=False):
            if field not in touched:
                old = self.fields.getValue((field,)) if self.fields.containsKey((field,)) else (None, -1, [])
                touched[field] = (old[0], old[1], [tuple(w) for w in old[2] or []])
            value = None if pd.isna(value) else str(value)
            touched[field] = step(touched[field], kind, None if pd.isna(seq) else int(seq), value)
        for field, state in touched.items():
            self.fields.updateValue((field,), state)
        shown = [(field, *visible(state)) for field, state in touched.items()]
        yield pd.DataFrame([(*key, f, v, n) for f, v, n in shown], columns=["lane", "field", "value", "waiting"]).astype({"value": "object", "waiting": "int64"})

    def close(self) -> None:
        pass


def step(state: tuple, kind: str, seq: int | None, value: str | None) -> tuple:
    """A field's (confirmed value, the sequence that it is known to, waiting edits) after an event."""
    confirmed, known, waiting = state
    if kind == "edit":
        return confirmed, known, [*waiting, (seq, value, False)]
    if kind == "response":
        waiting = [(s, v, done or s <= seq) for s, v, done in waiting]
        return (value, seq, waiting) if seq >= known else (confirmed, known, waiting)
    if kind == "echo":
        own = next((w for w in waiting if w[1] == value), None)
        if own is None:
            return value, known, waiting
        rest = [w for w in waiting if w is not own]
        return (value, own[0], rest) if not own[2] and own[0] > known else (confirmed, known, rest)
    own = next((w for w in waiting if w[0] == seq and not w[2]), None)
    if own is None:
        return state
    if kind == "fail":
        return confirmed, known, [w for w in waiting if w is not own]
    if seq > known:
        confirmed, known = own[1], seq
    waiting = [(s, v, done or s == seq) for s, v, done in waiting]
    return confirmed, known, waiting if not all(w[2] for w in waiting) else []


def visible(state: tuple) -> tuple[str | None, int]:
    """What a field shows, and how many of its edits wait for an answer."""
    open_ = [w for w in state[2] if not w[2]]
    return (open_[-1][1] if open_ else state[0]), len(open_)


def pending_fields(events: DataFrame) -> DataFrame:
    """(lane, field, value, waiting) of fields that events touch; events: lane, id, at, kind, field, seq, value."""
    return events.groupBy("lane").transformWithStateInPandas(PendingFields(), "lane long, field string, value string, waiting long", "Update", "None")


#: Votes lie in so many groups by key; one call of the processor works on a group, whose votes are a list in the state.
VOTE_GROUPS = 1024


class Votes(StatefulProcessor):
    """A vote that a second one of the same rating clears; a cleared vote, or one for nothing, leaves no state.

    A rating other than the one before it sets, and repeated it clears and sets in turn; so what a vote shows after a batch
    follows from its last run of equal ratings, and from the vote before only where the whole batch is that run."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.votes = handle.getListState("vote", "user_id bigint, place bigint, rating bigint")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:
        new = in_order(rows, ["ts", "event_id"])
        new["vote"] = new.groupby(["user_id", "place"], dropna=False, sort=False).ngroup()
        new = new.sort_values("vote", kind="stable")
        own = new["vote"] != new["vote"].shift()
        run = (own | (new["rating"] != new["rating"].shift())).cumsum()
        new = new.assign(size=new.groupby(run)["rating"].transform("size"), first=run == run.where(own).ffill())
        last = new[new["vote"] != new["vote"].shift(-1)]
        votes = {(u, p): r for u, p, r in self.votes.get()}
        shown = []
        for u, p, rating, size, first in last[["user_id", "place", "rating", "size", "first"]].itertuples(index=False):
            key = tuple(None if pd.isna(x) else int(x) for x in (u, p))
            clears = (size + (first and votes.get(key) == rating)) % 2 == 0
            now = 0 if clears else int(rating)
            votes.pop(key, None)
            if now:
                votes[key] = now
            shown.append((*key, now))
        if votes:
            self.votes.put([(*key, now) for key, now in votes.items()])
        else:
            self.votes.clear()
        yield pd.DataFrame(shown, columns=["user_id", "place", "rating"]).astype({"user_id": "Int64", "place": "Int64"})

    def close(self) -> None:
        pass


def toggled_votes(changes: DataFrame) -> DataFrame:
    """(user_id, place, rating) after each batch for the votes that it touches, 0 for cleared ones."""
    group = F.pmod(F.xxhash64("user_id", "place"), F.lit(VOTE_GROUPS)).alias("_group")
    rows = changes.select("user_id", "place", "rating", "ts", "event_id", group)
    return rows.groupBy("_group").transformWithStateInPandas(Votes(), "user_id long, place long, rating long", "Update", "None")


def drain_keyed(parts: list[DataFrame], plan: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """drain_arrivals for plans with state variables."""
    from wayforge.streaming.picks import drain_arrivals

    with keyed_state(parts[0].sparkSession):
        return drain_arrivals(parts, plan, "update", name)
