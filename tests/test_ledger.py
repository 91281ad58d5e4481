"""Commit records, replayed snapshots, pending edits and votes, over several batches."""

import pytest
from pyspark.sql import functions as F

from wayforge.operators import commits, publish
from wayforge.streaming import ledger, picks


def test_readers_of_a_stopped_publication(spark, tmp_path):
    root = str(tmp_path)
    rows = lambda n: spark.range(n).select(F.col("id").alias("k"))
    assert commits.write_version({"a": rows(3), "b": rows(4)}, root, {"revision": "one"}) == 0
    # a writer that stops between its tables and its record
    rows(9).write.parquet(f"{root}/data/version=1-dead/a")
    (tmp_path / "log" / "000000000001.json.dead.tmp").write_text('{"revision": "tw')
    revision, tables = publish.published(spark, root)
    assert revision == "one" and {k: t.count() for k, t in tables.items()} == {"a": 3, "b": 4}
    assert sorted(commits.recover(spark, root)) == ["000000000001.json.dead.tmp", "version=1-dead"]
    assert commits.write_version({"a": rows(5)}, root, {"revision": "two"}) == 1
    assert not commits.commit(spark, root, 1, {"revision": "late", "paths": {}})  # another writer was first
    assert publish.published(spark, root)[0] == "two" and commits.current(spark, root)["a"].count() == 5
    assert commits.recover(spark, root, keep=1) and commits.versions(spark, root) == [0, 1]
    assert not [n for n in commits.names(spark, f"{root}/log") if n.endswith(".tmp")]


def test_snapshot_then_replay(spark, tmp_path):
    schema = "k long, v string, seq long"
    frame = lambda *rows: spark.createDataFrame(rows, schema)
    batches = [frame((1, "b", 12), (2, "old", 3)), frame((1, "a", 11), (3, "c", 20)), frame((2, "new", 21), (4, "d", 22), (3, "older", 19))]
    snapshot = frame((1, "s1", 10), (2, "s2", 10), (5, "s5", 10))
    table = ledger.ReplayedTable(spark, str(tmp_path), snapshot.schema, ["k"], "seq", buckets=4)
    assert table.rows().count() == 0
    table.arrive(batches[0], 0)
    table.arrive(batches[0], 0)  # repeated while it waits
    assert table.rows().count() == 0 and commits.names(spark, f"{tmp_path}/waiting") == ["epoch=0"]
    table.load(snapshot)
    with pytest.raises(ValueError):
        table.load(snapshot)
    table.arrive(batches[0], 0)  # and after it was replayed
    table.arrive(batches[1], 1)
    version = commits.latest(spark, str(tmp_path))["version"]
    table.arrive(batches[1], 1)
    assert commits.latest(spark, str(tmp_path))["version"] == version
    # a merge that stops before its commit: its files are there, no reader sees them, and its epoch is merged again
    frame((4, "dead", 99)).write.parquet(f"{tmp_path}/data/version={version + 1}-epoch=2/bucket=1")
    table.arrive(batches[2], 2)
    want = picks.last_write_wins(snapshot.unionByName(batches[0]).unionByName(batches[1]).unionByName(batches[2]), ["k"], ["seq"])
    assert sorted(map(tuple, table.rows().collect())) == sorted((r.k, r.v, r.seq) for r in want.collect())
    assert {r.k: r.v for r in table.rows().collect()} == {1: "b", 2: "new", 3: "c", 4: "d", 5: "s5"}


def drive(spark, *batches):
    """What each field of lane 1 shows, and how many edits wait, after each batch of events (kind, field, seq, value)."""
    at, parts, shown = 0, [], []
    for batch in batches:
        rows = []
        for kind, field, seq, value in batch:
            at += 1
            rows.append((1, at, at, kind, field, seq, value))
        parts.append(spark.createDataFrame(rows, "lane long, id long, at long, kind string, field string, seq long, value string"))
    out = ledger.drain_keyed(parts, ledger.pending_fields, "test-pending").collect()
    now = {}
    for epoch in sorted({r.epoch for r in out}):
        now |= {r.field: (r.value, r.waiting) for r in out if r.epoch == epoch}
        shown.append(dict(now))
    return shown


def test_edits_wait_and_meet_their_echoes(spark):
    """An older request stays behind as a guard while a newer edit waits; its late echo does not show again."""
    one, two, three, four = drive(
        spark,
        [("response", "note", 0, "stored"), ("edit", "note", 1, "first"), ("edit", "note", 2, "second")],
        [("settle", "note", 1, None)],
        [("echo", "note", None, "first")],
        [("settle", "note", 2, None), ("settle", "note", 7, None)],
    )
    assert one == {"note": ("second", 2)} and two == {"note": ("second", 1)} and three == {"note": ("second", 1)} and four == {"note": ("second", 0)}


def test_fields_wait_each_on_its_own(spark):
    one, two, three = drive(
        spark,
        [("edit", "note", 1, "local note"), ("edit", "reviewed", 2, "true")],
        [("echo", "note", None, "local note"), ("echo", "reviewed", None, "false")],
        [("response", "note", 1, "remote note"), ("fail", "reviewed", 2, None)],
    )
    assert one == {"note": ("local note", 1), "reviewed": ("true", 1)}
    assert two == {"note": ("local note", 0), "reviewed": ("true", 1)}  # the echo of a row does not undo a newer field
    assert three == {"note": ("remote note", 0), "reviewed": ("false", 0)}


def test_answers_override_all_but_newer_edits(spark):
    one, two, three = drive(
        spark,
        [("edit", "note", 4, "before"), ("response", "note", 4, "answer")],
        [("edit", "note", 5, "typed after request"), ("response", "note", 4, "answer again")],
        [("response", "note", 3, "late answer"), ("fail", "note", 5, None)],
    )
    assert one == {"note": ("answer", 0)} and two == {"note": ("typed after request", 1)} and three == {"note": ("answer again", 0)}


def test_failures_go_back_to_the_confirmed_value(spark):
    one, two, three = drive(
        spark,
        [("response", "note", 0, "server"), ("edit", "note", 1, "failed A"), ("edit", "note", 2, "failed B")],
        [("fail", "note", 1, None)],
        [("fail", "note", 2, None), ("fail", "note", 2, None)],
    )
    assert one == {"note": ("failed B", 2)} and two == {"note": ("failed B", 1)} and three == {"note": ("server", 0)}


def test_votes_leave_no_state(spark):
    rows = [(1, 7, 3, 1), (2, 7, 4, 2), (1, 7, 3, 3), (2, 7, 2, 4), (2, 7, 2, 5), (3, 8, 0, 6), (3, 8, 0, 7)]
    votes = spark.createDataFrame([(u, p, r, i, i) for u, p, r, i in rows], "user_id long, place long, rating long, ts long, event_id long")
    parts = [votes.where("ts <= 2"), votes.where("ts in (3, 4)"), votes.where("ts > 4")]
    out = ledger.drain_keyed(parts, ledger.toggled_votes, "test-votes")
    assert picks.newest(out, ["user_id", "place"]).where("rating <> 0").count() == picks.votes_kept(votes).count() == 0
    checkpoint = out.inputFiles()[0].split("/rows/")[0] + "/checkpoint"
    with ledger.keyed_state(spark):
        assert spark.read.format("statestore").option("stateVarName", "vote").load(checkpoint).count() == 0
    still = ledger.drain_keyed([votes.where("ts <= 2"), votes.where("ts in (3, 4)")], ledger.toggled_votes, "test-votes")
    assert {(r.user_id, r.rating) for r in picks.newest(still, ["user_id", "place"]).where("rating <> 0").collect()} == {(2, 2)}


def test_votes_of_a_group_go_together(spark, monkeypatch):
    """Thousands of votes lie in a few groups of the state, and end as those that are toggled one by one."""
    monkeypatch.setattr(ledger, "VOTE_GROUPS", 2)
    random = lambda seed, n: F.floor(F.rand(seed) * n).cast("long")
    votes = spark.range(3000).select(F.when(F.col("id") % 9 > 0, random(1, 150)).alias("user_id"), random(2, 2).alias("place"), random(3, 3).alias("rating"), F.floor(F.col("id") / 2).alias("ts"), F.col("id").alias("event_id")).localCheckpoint()
    out = ledger.drain_keyed([votes.where(f"ts % 1500 >= {i * 500} and ts % 1500 < {i * 500 + 500}") for i in range(3)], ledger.toggled_votes, "test-groups")
    key = lambda r: (r.user_id is None, r.user_id, r.place, r.rating)
    got = sorted(map(key, picks.newest(out, ["user_id", "place"]).where("rating <> 0").collect()), key=str)
    assert got == sorted(map(key, picks.votes_kept(votes).collect()), key=str) and len(got) > 50
    assert out.select("user_id", "place").distinct().count() > 200
    with ledger.keyed_state(spark):
        state = spark.read.format("statestore").option("stateVarName", "vote").load(out.inputFiles()[0].split("/rows/")[0] + "/checkpoint")
        assert state.select("key").distinct().count() <= 2 < state.count()


def test_fingerprint_of_changes(spark):
    one = lambda rows: {(r.g, r.n, r.digest) for r in publish.fingerprint(spark.createDataFrame(rows, "g int, k int, s int"), ["g"], F.col("k"), F.col("s")).collect()}
    assert one([(1, 5, 1), (1, 6, 1), (1, 5, -1), (1, 8, 1), (1, 6, -1), (1, 9, 1)]) == one([(1, 9, 1), (1, 8, 1)])


def test_work_is_cleared(spark):
    from wayforge import session

    path = session.work_path(spark, "test-clear")
    spark.range(3).write.parquet(path)
    kept = session._made[:-1]
    session._made[:] = [path]  # other tests' tables stay
    assert session.clear_work(spark) == 1 and not commits.names(spark, path)
    session._made[:] = kept
