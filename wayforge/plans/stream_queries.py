"""Streaming queries over events, each held against its batch equivalent."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wayforge.plans.registry import query, read
from wayforge.streaming import ledger, picks

WHOLE = "CAST(floor(value) AS BIGINT)"


def events(spark, d):
    whole = F.floor("value").cast("bigint")
    return read(spark, d, "events").select("event_id", "ts", "user_id", "event_type", (whole % 20).alias("place"), (whole % 6).alias("rating"), whole.alias("whole"))


@query(f"SELECT user_id, {WHOLE} % 20 AS place, arg_max({WHOLE} % 6, (ts, event_id)) AS rating, max(event_id) FILTER (k = 1) AS event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, {WHOLE} % 20 ORDER BY ts DESC, event_id DESC) AS k FROM events) GROUP BY 1, 2")
def lww_state(spark, d):
    """O-ST1."""
    parts = picks.arrivals(events(spark, d).select("user_id", "place", "rating", "ts", "event_id"), "ts")
    plan = lambda stream: picks.last_write_wins(stream, ["user_id", "place"], ["ts", "event_id"])
    return picks.newest(picks.drain_arrivals(parts, plan, "update", "lww"), ["user_id", "place"]).select("user_id", "place", "rating", "event_id")


@query(f"""WITH e AS (SELECT user_id, {WHOLE} % 20 AS place, {WHOLE} % 6 AS rating, CASE WHEN event_id % 4 = 0 THEN event_id ELSE -1 END AS seq, event_id FROM events),
    s AS (SELECT user_id, place, arg_max(rating, event_id) AS rating FROM e WHERE seq = -1 GROUP BY 1, 2), c AS (SELECT user_id, place, arg_max(rating, seq) AS rating FROM e WHERE seq >= 0 GROUP BY 1, 2)
    SELECT coalesce(s.user_id, c.user_id) AS user_id, coalesce(s.place, c.place) AS place, coalesce(c.rating, s.rating) AS rating FROM s FULL JOIN c ON s.user_id = c.user_id AND s.place = c.place""")
def snapshot_replay(spark, d):
    """O-ST2: changes arrive in three batches, the snapshot after the first of them."""
    table = events(spark, d).where("event_id % 4 <> 0")
    snapshot = picks.last_write_wins(table.select("user_id", "place", "rating", F.col("event_id").alias("seq")), ["user_id", "place"], ["seq"])
    changes = events(spark, d).where("event_id % 4 = 0").select("user_id", "place", "rating", F.col("event_id").alias("seq"), "ts")
    parts = [p.drop("ts") for p in picks.arrivals(changes, "ts")]
    return ledger.replay_arrivals(parts, snapshot.drop("seq"), ["user_id", "place"], "seq", "replay").drop("seq")


EDITS = f"edits AS (SELECT user_id, event_id AS seq, CASE WHEN event_type IN ('click', 'view') THEN {WHOLE} % 6 END AS rating, CASE WHEN event_type IN ('view', 'error') THEN {WHOLE} END AS note FROM events)"


@query(f"""WITH {EDITS}, m AS (SELECT user_id, arg_max(rating, seq) FILTER (rating IS NOT NULL) AS rating, max(seq) FILTER (rating IS NOT NULL) AS rs, arg_max(note, seq) FILTER (note IS NOT NULL) AS note, max(seq) FILTER (note IS NOT NULL) AS ns FROM edits GROUP BY 1)
    SELECT user_id, CASE WHEN rs > 800 THEN rating ELSE -1 END AS rating, CASE WHEN ns > 800 THEN note ELSE -1 END AS note FROM m""")
def field_merge(spark, d):
    """O-ST3: fields edited after the request override the stored row, each on its own."""
    e = events(spark, d)
    edits = e.select("user_id", F.col("event_id").alias("seq"), F.when(F.col("event_type").isin("click", "view"), F.col("rating")).alias("rating"), F.when(F.col("event_type").isin("view", "error"), F.col("whole")).alias("note"), "ts")
    plan = lambda stream: picks.merge_fields(stream, ["user_id"], ["rating", "note"], "seq")
    merged = picks.newest(picks.drain_arrivals(picks.arrivals(edits, "ts"), plan, "update", "fields"), ["user_id"])
    stored = read(spark, d, "events").select("user_id").distinct().select("user_id", F.lit(-1).cast("bigint").alias("rating"), F.lit(-1).cast("bigint").alias("note"))
    return picks.overlay(stored, merged, ["user_id"], ["rating", "note"], F.lit(800))


@query("SELECT DISTINCT event_id // 2 AS id FROM events")
def echo_dedupe(spark, d):
    """O-ST4: two events carry one id, the write and its echo."""
    e = events(spark, d).select(F.floor(F.col("event_id") / 2).alias("id"), "ts")
    plan = lambda stream: picks.without_echoes(stream, "id", "ts", "60 days").select("id")
    return picks.drain_arrivals(picks.arrivals(e, "ts"), plan, "append", "echo").select("id")


@query("""WITH e AS (SELECT user_id AS lane, event_id, ts, event_type AS t, CASE event_type WHEN 'click' THEN 'note' WHEN 'view' THEN 'reviewed' END AS own FROM events),
    f AS (SELECT lane, event_id, ts, field, own IS NOT DISTINCT FROM field AS made, CASE WHEN own = field THEN 'edit' WHEN t = 'signup' THEN 'settle' WHEN t = 'purchase' AND field = 'note' THEN 'echo' WHEN t = 'error' AND field = 'reviewed' THEN 'fail' END AS kind FROM e, (VALUES ('note'), ('reviewed')) AS v(field)),
    r AS (SELECT *, CASE kind WHEN 'settle' THEN first_value(CASE WHEN made THEN event_id END IGNORE NULLS) OVER w WHEN 'edit' THEN event_id ELSE last_value(CASE WHEN made THEN event_id END IGNORE NULLS) OVER w END AS seq
        FROM f WHERE kind IS NOT NULL WINDOW w AS (PARTITION BY lane, field ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    s AS (SELECT lane, field, seq, arg_min(kind, (ts, event_id)) AS fate FROM r WHERE kind <> 'edit' AND seq IS NOT NULL GROUP BY 1, 2, 3),
    m AS (SELECT r.lane, r.field, r.seq, fate FROM r LEFT JOIN s ON s.lane = r.lane AND s.field = r.field AND s.seq = r.seq WHERE kind = 'edit')
    SELECT lane, field, CAST(coalesce(max(seq) FILTER (fate IS NULL), max(seq) FILTER (fate IN ('echo', 'settle'))) AS VARCHAR) AS value, count(*) FILTER (fate IS NULL) AS waiting FROM m GROUP BY 1, 2""")
def pending_fields(spark, d):
    """O-ST4 with O-ST3 and O-ST5: edits of two fields wait for what becomes of them. Sign-ups settle a field's first edit,
    purchases are echoes of the last note, errors fail the last review; an edit's value is its own number."""
    e = events(spark, d)
    own = F.when(F.col("event_type") == "click", "note").when(F.col("event_type") == "view", "reviewed")
    each = e.withColumn("own", own).withColumn("field", F.explode(F.array(F.lit("note"), F.lit("reviewed"))))
    kind = F.when(F.col("own") == F.col("field"), "edit").when(F.col("event_type") == "signup", "settle").when((F.col("event_type") == "purchase") & (F.col("field") == "note"), "echo").when((F.col("event_type") == "error") & (F.col("field") == "reviewed"), "fail")
    w = Window.partitionBy("user_id", "field").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    made = F.when(F.col("kind") == "edit", F.col("event_id"))
    seq = F.when(F.col("kind") == "edit", F.col("event_id")).when(F.col("kind") == "settle", F.first(made, True).over(w)).otherwise(F.last(made, True).over(w))
    log = each.withColumn("kind", kind).where("kind is not null").withColumn("seq", seq).where("seq is not null")
    log = log.select(F.col("user_id").alias("lane"), F.col("event_id").alias("id"), F.col("ts").alias("at"), "kind", "field", "seq", F.col("seq").cast("string").alias("value"))
    return picks.newest(ledger.drain_keyed(picks.arrivals(log, "at"), ledger.pending_fields, "pending"), ["lane", "field"])


@query(f"""WITH e AS (SELECT user_id AS key, event_id, ts, event_type AS t, {WHOLE} AS value, CASE WHEN event_type IN ('click', 'view') THEN event_id END AS own FROM events),
    r AS (SELECT *, CASE WHEN own IS NOT NULL THEN own WHEN t = 'signup' THEN first_value(own IGNORE NULLS) OVER w ELSE last_value(own IGNORE NULLS) OVER w END AS ref FROM e WINDOW w AS (PARTITION BY key ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    s AS (SELECT key, ref, arg_min(t, (ts, event_id)) AS how, min((ts, event_id)) AS settled FROM r WHERE own IS NULL AND ref IS NOT NULL GROUP BY 1, 2),
    m AS (SELECT r.key, r.value, (r.ts, r.event_id) AS made, how, settled FROM r LEFT JOIN s ON s.key = r.key AND s.ref = r.own WHERE own IS NOT NULL),
    a AS (SELECT key, arg_max(value, settled) FILTER (how = 'purchase') AS confirmed, arg_max(value, made) FILTER (how IS NULL) AS newest, count(*) FILTER (how IS NULL) AS waiting FROM m GROUP BY 1)
    SELECT k.key, confirmed, coalesce(newest, confirmed) AS visible, coalesce(waiting, 0) AS waiting FROM (SELECT DISTINCT key FROM e) k LEFT JOIN a USING (key)""")
def rollback(spark, d):
    """O-ST5: purchases confirm the last edit, errors fail it, sign-ups fail the first one; in three batches of arrivals."""
    own = F.when(F.col("event_type").isin("click", "view"), F.col("event_id"))
    kind = F.when(own.isNotNull(), "edit").when(F.col("event_type") == "purchase", "confirm").otherwise("fail")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ref = F.when(own.isNotNull(), own).when(F.col("event_type") == "signup", F.first(own, True).over(w)).otherwise(F.last(own, True).over(w))
    e = events(spark, d).select(F.col("user_id").alias("key"), kind.alias("kind"), ref.alias("mutation"), F.col("whole").alias("value"), "ts", "event_id")
    return picks.newest(picks.drain_arrivals(picks.arrivals(e, "ts"), picks.rollback, "update", "rollback"), ["key"])


@query(f"""WITH c AS (SELECT event_id AS id, user_id AS writer, CASE WHEN event_id % 3 = 0 THEN user_id ELSE {WHOLE} % 40 END AS owner, {WHOLE} % 20 AS place FROM events),
    o AS (SELECT event_id AS id, user_id AS owner, {WHOLE} % 20 AS place FROM events WHERE event_id % 7 = 0)
    SELECT c.id, writer, c.owner, c.place, CASE WHEN o.id IS NOT NULL AND (o.owner <> c.owner OR o.place <> c.place) THEN 'identity' WHEN writer % 15 = 0 AND writer < 120 AND c.owner < 100 THEN 'ok' WHEN writer % 15 = 0 AND writer < 120 THEN 'not-a-member'
        WHEN writer < 100 AND writer = c.owner THEN 'ok' WHEN writer < 100 THEN 'not-own' ELSE 'no-member' END AS verdict FROM c LEFT JOIN o USING (id)""")
def admission(spark, d):
    """O-ST7, O-J14, O-J15: a stream of changes against tables of members, admins and owners."""
    e = events(spark, d)
    changes = e.select("ts", F.col("event_id").alias("id"), F.col("user_id").alias("writer"), F.when(F.col("event_id") % 3 == 0, F.col("user_id")).otherwise(F.col("whole") % 40).alias("owner"), "place")
    people = read(spark, d, "events").select("user_id").distinct()
    known = people.union(spark.range(40).select(F.col("id").alias("user_id"))).distinct()
    owners = events(spark, d).where("event_id % 7 = 0").select(F.col("event_id").alias("id"), F.col("user_id").alias("owner"), "place")
    plan = lambda stream: picks.admitted(stream, known.where("user_id < 100"), people.where("user_id % 15 = 0 and user_id < 120"), owners)
    return picks.drain_arrivals(picks.arrivals(changes, "ts"), plan, "append", "admission").drop("epoch")


@query("SELECT user_id, arg_max(md5(event_type), (ts, event_id)) AS hash FROM events GROUP BY 1")
def watch_increment(spark, d):
    """O-ST8: the incremental cycle over three arrivals; the newest result of each key."""
    e = events(spark, d).select("user_id", F.md5("event_type").alias("hash"), F.struct("ts", "event_id").alias("at_"), "ts")
    done = picks.watch(picks.arrivals(e, "ts"), lambda df: df, "user_id", "hash", "at_", "watch")
    return done.groupBy("user_id").agg(F.max_by("hash", "at").alias("hash"))


@query(f"""WITH e AS (SELECT user_id, {WHOLE} % 20 AS place, {WHOLE} % 6 AS rating, ts, event_id FROM events), l AS (SELECT *, lag(rating) OVER (PARTITION BY user_id, place ORDER BY ts, event_id) AS last FROM e),
    r AS (SELECT *, sum(CASE WHEN rating = last THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, place ORDER BY ts, event_id) AS run FROM l), s AS (SELECT user_id, place, run, count(*) AS k, max(rating) AS rating FROM r GROUP BY 1, 2, 3),
    f AS (SELECT user_id, place, CASE WHEN arg_max(k, run) % 2 = 1 THEN arg_max(rating, run) ELSE 0 END AS rating FROM s GROUP BY 1, 2) SELECT * FROM f WHERE rating <> 0""")
def vote_prune(spark, d):
    """O-ST9: toggled votes clear, empty records go; the votes are state of a stream of three batches."""
    parts = picks.arrivals(events(spark, d).select("user_id", "place", "rating", "ts", "event_id"), "ts")
    return picks.newest(ledger.drain_keyed(parts, ledger.toggled_votes, "votes"), ["user_id", "place"]).where("rating <> 0")
