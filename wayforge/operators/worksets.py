"""Incremental work: overrides, stale and missing keys, upserts, kept partitions, quarantine."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def curated_override(generated: DataFrame, curated: DataFrame, key: str, value: str, hash_: str, checked: str | None = None) -> DataFrame:
    """The curated value where it was made for the current hash and, with ``checked``, on the same date; else the generated one."""
    c = curated.select(key, F.col(value).alias("_value"), F.col(hash_).alias("_hash"), *([F.col(checked).alias("_checked")] if checked else []))
    good = F.col("_hash").eqNullSafe(F.col(hash_)) & F.col("_value").isNotNull()
    if checked:
        good = good & F.col("_checked").eqNullSafe(F.col(checked))
    return generated.join(c, key, "left").select(key, F.when(good, F.col("_value")).otherwise(F.col(value)).alias(value), F.when(good, "curated").otherwise("generated").alias("source"))


def reconcile(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """(key, state): matched, missing or unexpected, for every key of either side."""
    a, b = expected.select(key).distinct().withColumn("_e", F.lit(1)), present.select(key).distinct().withColumn("_p", F.lit(1))
    return a.join(b, key, "full_outer").select(key, F.when(F.col("_e").isNull(), "unexpected").when(F.col("_p").isNull(), "missing").otherwise("matched").alias("state"))


def reconcile_issues(state: DataFrame, key: str, strict: bool) -> DataFrame:
    """Issue rows of a reconciliation; the partial mode tolerates missing keys only."""
    bad = state.where("state = 'unexpected'" + (" or state = 'missing'" if strict else ""))
    return bad.select(F.col(key).cast("string").alias("key"), F.when(F.col("state") == "missing", "missing-context").otherwise("unexpected-context").alias("code"))


def stale_keys(current: DataFrame, stored: DataFrame, key: str, hash_: str) -> DataFrame:
    """Keys to do again: never done, or done for another hash. Stored keys that left the inventory play no part."""
    s = stored.select(key, F.col(hash_).alias("_done"))
    return current.join(s, key, "left").where(~F.col(hash_).eqNullSafe(F.col("_done"))).select(key, F.when(F.col("_done").isNull(), "new").otherwise("changed").alias("why"))


def upsert_in_order(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of old (with ordinal) replaced in place by new ones of the same key; others of new follow in their order.

    Within new the last row of a key counts, at the place of its first."""
    columns = [c for c in new.columns if c not in (key, "ordinal")]
    last = new.groupBy(key).agg(F.max_by(F.struct(*columns), "ordinal").alias("_new"), F.min("ordinal").alias("_at"))
    top = old.agg(F.coalesce(F.max("ordinal"), F.lit(0)).alias("_top"))
    merged = old.join(last, key, "full_outer").join(F.broadcast(top))  # one row
    pick = [F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    return merged.select(key, *pick, F.coalesce("ordinal", F.col("_top") + F.col("_at")).alias("ordinal"))


def preserve_failed(prior: DataFrame, current: DataFrame, failed: DataFrame) -> DataFrame:
    """current (identity, category, also) plus the prior rows of failed categories that are not in it; a row that came
    back under another category gets the failed one among its others."""
    lost = prior.join(failed, "category", "left_semi")
    restored = lost.join(current.select("identity"), "identity", "left_anti").select("identity", "category", "also", F.lit(True).alias("restored"))
    add = lost.groupBy("identity").agg(F.array_sort(F.collect_set("category")).alias("_lost"))
    kept = current.join(add, "identity", "left")
    also = F.array_except(F.array_union("also", F.coalesce("_lost", F.array().cast("array<string>"))), F.array("category"))
    return kept.select("identity", "category", also.alias("also"), F.lit(False).alias("restored")).unionByName(restored)


def replace_partitions(existing: DataFrame, new: DataFrame, key: str, selected: DataFrame | None = None) -> DataFrame:
    """All partitions of new in place of existing ones, and of the selected keys also those without new rows; the others stay."""
    keys = new.select(key) if selected is None else new.select(key).union(selected.select(key))
    return existing.join(keys.distinct(), key, "left_anti").unionByName(new)


def write_partitions(new: DataFrame, path: str, key: str) -> None:
    """Overwrites on disk only the partitions that new has."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def quarantine(rows: DataFrame, entity: str, got: str, wanted: str) -> DataFrame:
    """Counts by entity of rows whose identity is the wanted one, of foreign ones (and different ones among them), and of
    those without any."""
    ok = F.col(got).isNotNull() & (F.col(got) == F.col(wanted))
    foreign = F.when(F.col(got).isNotNull() & (F.col(got) != F.col(wanted)), F.col(got))
    per = rows.groupBy(entity, foreign.alias("_foreign")).agg(F.count("*").alias("_n"), F.count_if(ok).alias("_ok"), F.count_if(F.col(got).isNull()).alias("_none"))
    return per.groupBy(entity).agg(F.sum("_n").alias("returned"), F.sum("_ok").alias("accepted"), (F.sum("_n") - F.sum("_ok")).alias("quarantined"), F.sum("_none").alias("missing_id"), F.count("_foreign").alias("rejected"))


def accepted_rows(rows: DataFrame, got: str, wanted: str) -> DataFrame:
    """The rows of their own entity."""
    return rows.where(F.col(got).isNotNull() & (F.col(got) == F.col(wanted)))


def rejected_ids(rows: DataFrame, entity: str, got: str, wanted: str) -> DataFrame:
    """(entity, id, at): the different foreign ids of each entity, in their order; rows, as an entity may have any number."""
    ids = rows.where(F.col(got).isNotNull() & (F.col(got) != F.col(wanted))).select(entity, F.col(got).alias("id")).distinct()
    return ids.withColumn("at", F.row_number().over(Window.partitionBy(entity).orderBy("id")))


def quarantine_issues(counts: DataFrame, entity: str) -> DataFrame:
    """(entity, code): counts that do not add up, more rows without an id than quarantined ones, a stored total that is not
    what was accepted, and a source total below it. Columns source_total and stored_total are optional."""
    rules = {"sum": F.col("returned") != F.col("accepted") + F.col("quarantined"), "missing": F.col("missing_id") > F.col("quarantined"), "rejected": F.col("rejected") > F.col("quarantined") - F.col("missing_id")}
    if "source_total" in counts.columns:
        rules["source-total"] = F.col("source_total") < F.col("accepted")
    if "stored_total" in counts.columns:
        rules["stored-total"] = F.col("stored_total") != F.col("accepted")
    found = F.array_compact(F.array(*(F.when(test, F.lit(code)) for code, test in rules.items())))
    return counts.select(entity, F.explode(found).alias("code"))


def key_set_issues(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """(table, key) of keys that some tables have and this one lacks; none if all key sets are equal."""
    every = functools.reduce(DataFrame.union, (t.select(key) for t in tables.values())).distinct()
    return functools.reduce(DataFrame.union, (every.join(t.select(key), key, "left_anti").select(F.lit(name).alias("table"), key) for name, t in tables.items()))


def latest_kept(releases: DataFrame, order: str, kept: int = 2) -> DataFrame:
    """releases with keep: the active one and the one before. No window: the top ``kept`` are few, whatever the table."""
    top = releases.select(order).distinct().orderBy(F.desc(order)).limit(kept).agg(F.min(order).alias("_least"))
    return releases.join(F.broadcast(top)).withColumn("keep", F.coalesce(F.col(order) >= F.col("_least"), F.lit(False))).drop("_least")  # one row


def merge_catalogs(first: DataFrame, second: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(merged, proof): second's rows whose key first lacks follow first's; proof has one row (first, second, dropped,
    merged, proven), whether merged = first + second - dropped."""
    merged = first.unionByName(second.join(first.select(key), key, "left_anti"))
    part = lambda df, name: df.select(F.lit(name).alias("_part"))
    parts = [part(merged, "merged"), part(first, "first"), part(second, "second"), part(second.join(first.select(key), key, "left_semi"), "dropped")]
    counts = functools.reduce(DataFrame.union, parts).agg(*(F.count_if(F.col("_part") == p).alias(p) for p in ("first", "second", "dropped", "merged")))
    return merged, counts.withColumn("proven", F.col("merged") == F.col("first") + F.col("second") - F.col("dropped"))


def work_left(queue: DataFrame, judged: DataFrame, key: str, verdict: str, again: list) -> DataFrame:
    """(key, todo): queued keys that were never judged (remaining) or judged as one of ``again``."""
    rest = queue.join(judged, key, "left_anti").select(key, F.lit("remaining").alias("todo"))
    return rest.unionByName(queue.join(judged.where(F.col(verdict).isin(*again)), key, "left_semi").select(key, F.lit("again").alias("todo")))


def set_sides(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """(side, key): keys of the first only, of the second only, and of both."""
    side = lambda df, name: df.select(F.lit(name).alias("side"), key)
    a, b = first.select(key), second.select(key)
    return side(a.subtract(b), "only first").union(side(b.subtract(a), "only second")).union(side(a.intersect(b), "both"))
