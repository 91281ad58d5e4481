"""Duplicates by name, and owners of names and aliases across snapshots."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_match(new: DataFrame, existing: DataFrame) -> DataFrame:
    """new (id, norm) with the first existing (orig, norm, ordinal) of the same normal name; unmatched rows are new."""
    first = existing.where("norm <> ''").groupBy("norm").agg(F.min_by("orig", "ordinal").alias("matched"))
    return new.join(first, "norm", "left").withColumn("status", F.when(F.col("matched").isNull(), "new").otherwise("dup"))


#: Characters of the runs by which names meet.
RUN = 5


def guarded_containment(new: DataFrame, existing: DataFrame, least_chars: int = 13, least_words: int = 2) -> DataFrame:
    """(id, orig, ordinal): rows whose normal name holds an existing one or is held by it, or equals it; the first existing row wins.

    Both have norm and kind; existing has is_generic. The shorter name must be long enough and of several words, and the
    kinds equal. Whatever holds a name holds all its runs of five characters; candidates meet on its rarest one, counted
    among all names, and are compared only then. Equal names are one candidate, whatever their number."""
    a = new.select(F.col("norm").alias("a"), F.col("kind").alias("ka")).distinct()
    b = existing.where("not is_generic and norm <> ''").select(F.col("norm").alias("b"), F.col("kind").alias("kb")).distinct()
    good = lambda c: (F.length(c) >= least_chars) & (F.size(F.split(c, " ")) >= least_words)
    runs = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - RUN + 1), lambda i: F.substring(c, i, F.lit(RUN))))
    every = lambda df, c: df.where(F.length(c) >= RUN).select("*", F.explode(runs(F.col(c))).alias("run"))
    counts = every(a, "a").select("run").union(every(b, "b").select("run")).groupBy("run").agg(F.count("*").alias("_n"))
    rarest = lambda df, c: every(df.where(good(F.col(c))), c).join(counts, "run").groupBy(*df.columns).agg(F.min_by("run", F.struct("_n", "run")).alias("run"))
    held = rarest(b, "b").join(every(a, "a"), "run").where(F.contains("a", "b") & (F.col("ka") == F.col("kb")))
    holds = rarest(a, "a").join(every(b, "b"), "run").where(F.contains("b", "a") & (F.col("ka") == F.col("kb")))
    pairs = held.select("a", "ka", "b").union(holds.select("a", "ka", "b")).distinct()
    named = existing.where("not is_generic").groupBy(F.col("norm").alias("b"), F.col("kind").alias("ka")).agg(F.min(F.struct("ordinal", "orig")).alias("m"))
    best = pairs.join(named, ["b", "ka"]).groupBy("a", "ka").agg(F.min("m").alias("m"))
    equal = existing.where("norm <> ''").groupBy(F.col("norm").alias("a")).agg(F.min(F.struct("ordinal", "orig")).alias("e"))
    rows = new.where("norm <> ''").select("id", F.col("norm").alias("a"), F.col("kind").alias("ka")).join(best, ["a", "ka"], "left").join(equal, "a", "left")
    return rows.select("id", F.least("m", "e").alias("m")).where("m is not null").groupBy("id").agg(F.min("m").alias("m")).select("id", "m.orig", "m.ordinal")


def _large(df: DataFrame) -> DataFrame:
    """A side that grows with the input, to be shuffled: files of repeated names are small, so by their size plans would
    broadcast all of it through the driver."""
    return df.hint("merge")


def legacy_owner(df: DataFrame, city: str, name: str, id_: str) -> DataFrame:
    """The smallest id of a (city, name) owns the bare key; the others get their id as a suffix."""
    rn = F.row_number().over(Window.partitionBy(city, name).orderBy(id_))
    return df.select(id_, F.concat(F.concat_ws("|", city, name), F.when(rn == 1, "").otherwise(F.concat(F.lit("#"), F.col(id_)))).alias("key"))


def ordinal_pairs(old: DataFrame, new: DataFrame, group: list[str], id_: str) -> DataFrame:
    """Pairs by ascending id within groups whose two sides have equally many rows."""
    w = Window.partitionBy(*group)
    a = old.select(*group, F.col(id_).alias("old_id"), F.row_number().over(w.orderBy(id_)).alias("rn"), F.count("*").over(w).alias("_n"))
    b = new.select(*group, F.col(id_).alias("new_id"), F.row_number().over(w.orderBy(id_)).alias("rn"), F.count("*").over(w).alias("_m"))
    return a.join(_large(b), [*group, "rn"]).where("_n = _m").select(*group, "old_id", "new_id")


def snapshot_owners(old: DataFrame, new: DataFrame) -> DataFrame:
    """(city, name, id, owner, how): which row of the target snapshot owns each row of an old one; both have city, name, id.

    In turn: the only target of that name; the same id among several targets of the name; the leftovers of a name in order
    of ids, if equally many; else the row itself."""
    a = old.select("city", "name", "id")
    per = new.groupBy("city", "name").agg(F.count("*").alias("_n"), F.min("id").alias("_only"))
    mine = new.select("city", "name", "id", F.lit(True).alias("_same"))
    step = a.join(_large(per), ["city", "name"], "left").join(_large(mine), ["city", "name", "id"], "left").withColumn("_many", F.coalesce(F.col("_n") > 1, F.lit(False)))
    left = step.where("_many and _same is null").select("city", "name", "id")
    free = new.select("city", "name", "id").join(_large(per.where("_n > 1").select("city", "name")), ["city", "name"], "left_semi").join(_large(a), ["city", "name", "id"], "left_anti")
    pairs = ordinal_pairs(left, free, ["city", "name"], "id").select("city", "name", F.col("old_id").alias("id"), F.col("new_id").alias("_paired"))
    out = step.join(_large(pairs), ["city", "name", "id"], "left")
    single = F.when(F.col("_n") == 1, F.col("_only"))
    same = F.col("_many") & F.coalesce("_same", F.lit(False))
    how = F.when(single.isNotNull(), "name").when(same, "identity").when(F.col("_paired").isNotNull(), "order").otherwise("self")
    return out.select("city", "name", "id", F.coalesce(single, F.when(same, F.col("id")), "_paired", "id").alias("owner"), how.alias("how"))


def alias_owners(snapshots: list[DataFrame], new: DataFrame, explicit: DataFrame) -> DataFrame:
    """(alias, owner, how, snapshot): the owner, in the target snapshot, of every key that older snapshots gave.

    snapshots, the oldest first: (city, name, id, aliases array<string>); a row's keys are its aliases and its legacy key.
    The first snapshot that claims an alias keeps it; explicit targets (alias, target) that exist override that."""
    claims = []
    for n, old in enumerate(snapshots, 1):
        keys = legacy_owner(old, "city", "name", "id").select("id", F.col("key").alias("_key"))
        rows = snapshot_owners(old, new).join(_large(old.select("city", "name", "id", "aliases")), ["city", "name", "id"]).join(_large(keys), "id")
        claims.append(rows.select("id", "owner", "how", F.explode(F.array_append(F.coalesce("aliases", F.array().cast("array<string>")), F.col("_key"))).alias("alias"), F.lit(n).alias("snapshot")))
    first = functools.reduce(DataFrame.union, claims).groupBy("alias").agg(F.min_by(F.struct("owner", "how", "snapshot"), F.struct("snapshot", "id")).alias("f")).select("alias", "f.*")
    told = explicit.join(_large(new.select(F.col("id").alias("target")).distinct()), "target", "left_semi")
    out = first.join(told, "alias", "left")
    return out.select("alias", F.coalesce("target", "owner").alias("owner"), F.when(F.col("target").isNotNull(), "explicit").otherwise(F.col("how")).alias("how"), "snapshot")


def unowned(expected: DataFrame, emitted: DataFrame, key: list[str]) -> DataFrame:
    """Keys that old snapshots had and that no current row owns."""
    return expected.select(*key).distinct().join(_large(emitted), key, "left_anti")
