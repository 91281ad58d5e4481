"""Evidence hashes, gates, versioned output, fingerprints, exports and nested-key scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayforge.functions.nested import json_nodes
from wayforge.operators import commits
from wayforge.operators.ranking import positioned


def canonical_hash(version: int, **fields: Column) -> Column:
    """SHA-256 of the canonical JSON of the fields in order of their names, nulls kept, with the version."""
    item = F.struct(*(fields[k].alias(k) for k in sorted(fields)))
    return F.sha2(F.to_json(F.struct(item.alias("item"), F.lit(version).alias("version")), {"ignoreNullFields": "false"}), 256)


def fingerprint(df: DataFrame, group: list[str], ref: Column, sign: Column | None = None) -> DataFrame:
    """(group, n, digest): a digest of membership that no order changes.

    Members are hashed each and the first 128 bits of the hashes added up as four words in decimals, so no group is collected.
    With ``sign``, 1 for members that come and -1 for those that go, the rows are changes, of a table or of a stream, and
    the digest is that of the members left."""
    sign = F.lit(1) if sign is None else sign
    h = F.sha2(ref.cast("string"), 256)
    word = lambda i: F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("decimal(38,0)")
    sums = df.groupBy(*group).agg(F.sum(sign).cast("long").alias("n"), *(F.sum(word(i) * sign.cast("decimal(1,0)")).cast("decimal(38,0)").alias(f"_w{i}") for i in range(4)))
    return sums.select(*group, "n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), *(F.col(f"_w{i}").cast("string") for i in range(4))), 256).alias("digest"))


def gate(expected: DataFrame, records: dict[str, DataFrame], errors: DataFrame, key: str) -> DataFrame:
    """One row (ok, missing, errors): whether every expected key has all records and none has a current error."""
    missing = expected.select(key)
    have = missing
    for table in records.values():
        have = have.join(table.select(key).distinct(), key, "left_semi")
    a = missing.join(have, key, "left_anti").agg(F.count("*").alias("missing"))
    b = errors.join(expected, key, "left_semi").agg(F.count("*").alias("errors"))
    return a.join(F.broadcast(b)).select(((F.col("missing") == 0) & (F.col("errors") == 0)).alias("ok"), "missing", "errors")  # one row each


def publish(tables: dict[str, DataFrame], gate_row: DataFrame, root: str, revision: str) -> bool:
    """Publishes all tables as one version that carries the revision, or nothing if the gate is not ok.

    Readers follow ``published``: until the version's record is written, which takes one rename, they get the version
    before, and two writers cannot make the same version."""
    if not gate_row.first()["ok"]:
        return False
    stamped = {name: df.withColumn("revision", F.lit(revision)) for name, df in tables.items()}
    return commits.write_version(stamped, root, {"revision": revision}) is not None


def published(spark: SparkSession, root: str) -> tuple[str | None, dict[str, DataFrame]]:
    """The current revision and its tables; None and nothing before the first."""
    now = commits.latest(spark, root)
    return (now["revision"], commits.current(spark, root)) if now else (None, {})


def verify(records: DataFrame, evidence: DataFrame, key: str) -> DataFrame:
    """(key, code): records (hash, revision) whose hash is not the evidence's (key, hash), or whose revision is not the one
    recomputed from the records' hashes."""
    e = evidence.select(key, F.col("hash").alias("_h"))
    now = revision(records, key).select(F.col("digest").alias("_revision"))
    out = records.join(e, key, "left").join(F.broadcast(now))  # one row
    codes = F.array_compact(F.array(F.when(F.col("_h").isNull(), F.lit("no-evidence")), F.when(F.col("_h") != F.col("hash"), F.lit("stale")), F.when(~F.col("revision").eqNullSafe(F.col("_revision")), F.lit("revision"))))
    return out.select(key, F.explode(codes).alias("code"))


def revision(records: DataFrame, key: str) -> DataFrame:
    """One row (n, digest) over the keys and hashes of records, in whatever order."""
    return fingerprint(records.withColumn("_all", F.lit(1)), ["_all"], F.concat_ws(":", F.col(key).cast("string"), "hash")).drop("_all")


def report(issues: DataFrame, expected: DataFrame, present: DataFrame, key: str, source: str | None = None) -> DataFrame:
    """(part, name, n): expected, present and audited keys, missing and unexpected ones, issues by code and in all, rows by
    coverage source (a column of present), and ok, 1 if nothing is missing, unexpected or wrong."""
    # each input is read once: keys are met in one grouping, issues and sources are counted by name
    flags = expected.select(key, F.lit(1).alias("_e"), F.lit(0).alias("_p")).union(present.select(key, F.lit(0), F.lit(1)))
    keys = flags.groupBy(key).agg(F.max("_e").alias("_e"), F.max("_p").alias("_p"))
    e, p = F.col("_e") == 1, F.col("_p") == 1
    tests = {"expected": e, "present": p, "audited": e & p, "missing": e & ~p, "unexpected": p & ~e}
    counts = keys.agg(*(F.count_if(t).alias(n) for n, t in tests.items()))
    codes = issues.groupBy("code").agg(F.count("*").alias("n"))
    named = codes.select(F.lit("code").alias("part"), F.col("code").alias("name"), "n")
    if source:
        named = named.union(present.groupBy(source).agg(F.count("*").alias("n")).select(F.lit("source"), F.col(source).cast("string"), "n"))
    # one row each, so that the rows of a name are the names of a report
    rows = counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in tests))).alias("r")).select("r.name", "r.n")
    total = codes.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("n")).select(F.lit("issues").alias("name"), "n")
    summary = rows.union(total)
    wrong = F.sum(F.when(F.col("name").isin("missing", "unexpected", "issues"), F.col("n")).otherwise(0))
    ok = summary.agg(F.when(wrong == 0, 1).otherwise(0).cast("long").alias("n")).select(F.lit("ok").alias("part"), F.lit("ok").alias("name"), "n")
    return summary.select(F.lit("count").alias("part"), "name", "n").union(named).union(ok)


def disagreements(a: DataFrame, b: DataFrame, key: str, fields: list[str], code: str = "metadata", group: str | None = None) -> DataFrame:
    """(key, code, field) of the fields in which two tables differ for a key, nulls being equal; with ``group`` also that.

    group: a column of both tables that the key's rows share and of which each value has a few rows. The tables are then
    joined by it, so those that already lie by it are not shuffled again."""
    theirs = [F.col(f).alias(f"_{f}") for f in fields]
    if group:
        rows = b.select(group, F.struct(F.col(key).alias("_key"), *theirs).alias("_b")).groupBy(group).agg(F.collect_list("_b").alias("_b"))
        both = a.select(group, key, *fields).join(rows, group)
        both = both.withColumn("_b", F.explode(F.filter("_b", lambda x: x["_key"] == F.col(key)))).select(group, key, *fields, "_b.*")
    else:
        both = a.select(key, *fields).join(b.select(key, *theirs), key)
    found = F.array_compact(F.array(*(F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in fields)))
    return both.select(*([group] if group else []), key, F.lit(code).alias("code"), F.explode(found).alias("field"))


def nested_keys(df: DataFrame, key: str, document: str, denied: list[str]) -> DataFrame:
    """(key, path) of all object keys, at any depth of a JSON text, that are on the deny-list without underscores and in small
    letters; a text that is no JSON has the path ``invalid``, and a null or empty one none."""
    some = df.select(key, F.nullif(F.col(document), F.lit("")).alias("_document")).where("_document is not null")
    nodes = some.select(key, F.explode(json_nodes(F.array("_document"))).alias("_n"))
    path = F.when(F.col("_n.kind") == "invalid", "invalid").when(F.lower(F.replace("_n.name", F.lit("_"), F.lit(""))).isin(*denied), F.col("_n.path"))
    return nodes.select(key, path.alias("path")).where("path is not null")


def allow_listed(df: DataFrame, key: str, document: str, schema: str) -> DataFrame:
    """(key, document) of JSON documents that keep only the fields of the schema, at any depth."""
    return df.select(key, F.to_json(F.from_json(document, schema)).alias(document))


def export(rows: DataFrame, version: int = 3) -> DataFrame:
    """(member, line, text): the lines of a document for each member (rows: member, kind activity or category, key, rating,
    note, reviewed), which has schemaVersion and the activities and categories as arrays in order of their keys.

    Categories that are neither reviewed nor have a note are left out. A document is lines, not one value, as a member
    may have any number of rows; a writer that sorts by member and line gets documents."""
    kept = rows.where((F.col("kind") != "category") | F.col("reviewed") | (F.trim("note") != ""))
    placed = positioned(kept.select("member", "kind", "key", "rating", "note", "reviewed"), [F.col("key")], ("member", "kind"))
    item = F.to_json(F.struct("key", "rating", "note", "reviewed"), {"ignoreNullFields": "false"})
    text = F.concat(F.when(F.col("position") > 1, ",").otherwise(""), item)
    items = placed.select("member", F.when(F.col("kind") == "activity", 1).otherwise(3).alias("_part"), F.col("position").alias("_at"), text.alias("text"))
    frame = F.explode(F.array(*(F.struct(F.lit(n).alias("_part"), F.lit(t).alias("text")) for n, t in ((0, f'{{"schemaVersion":{version},"activities":['), (2, '],"categories":['), (4, "]}")))))
    frames = kept.select("member").distinct().select("member", frame.alias("f")).select("member", "f._part", F.lit(0).cast("long").alias("_at"), "f.text")
    return items.unionByName(frames).select("member", F.col("_part").alias("section"), F.col("_at").alias("line"), "text")
