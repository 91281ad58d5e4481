"""Scores, stable orders, facets, top rows and batches."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayforge.session import work_path


def bayes_score(rating: Column, reviews: Column, prior_weight: int = 50, prior_mean: float = 4.0) -> Column:
    """Rating pulled to the prior by few reviews; 0 without a rating, and a null count is 0."""
    n = F.coalesce(reviews, F.lit(0))
    score = n / (n + prior_weight) * rating + F.lit(prior_weight) / (n + prior_weight) * F.lit(prior_mean)
    return F.when(rating.isNull(), F.lit(0.0)).otherwise(score)


def faceted(df: DataFrame, facets: dict[str, list], many: tuple[str, ...] = ()) -> DataFrame:
    """OR within a facet, AND between facets; an empty facet restricts nothing; columns in many are arrays."""
    tests = [F.arrays_overlap(F.col(c), F.array(*map(F.lit, v))) if c in many else F.col(c).isin(v) for c, v in facets.items() if v]
    return df.where(functools.reduce(lambda a, b: a & b, tests)) if tests else df


def facet_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n) of the values present, in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns)))
    return df.select(pairs.alias("p")).select("p.*").where("value is not null").groupBy("facet", "value").agg(F.count("*").alias("n"))


def top_unique(df: DataFrame, entity: str, parts: list[str], order: list, most: int = 10) -> DataFrame:
    """The first ``most`` distinct rows (by parts) of each entity in source order, with ``pos`` from 1."""
    first = df.withColumn("_k", F.row_number().over(Window.partitionBy(entity, *parts).orderBy(*order))).where("_k = 1").drop("_k")
    return first.withColumn("pos", F.row_number().over(Window.partitionBy(entity).orderBy(*order))).where(F.col("pos") <= most)


def grouped_in_order(df: DataFrame, group: str, order: DataFrame, name: str) -> DataFrame:
    """Counts by group in the dictionary's order; groups without rows are dropped. order: (group, ordinal)."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.min(name).alias("first_name")).join(F.broadcast(order), group).select(group, "ordinal", "n", "first_name")


def positioned(df: DataFrame, order: list, within: tuple[str, ...] = ()) -> DataFrame:
    """df with ``position`` (from 1) in the order, or inside each group of ``within``; the order must be a total one.

    The rows are written range by range to the shared folder, each with the number of its range; positions are the
    rank in the range plus the rows before it, so no task sees all rows, or all of a group. Writing first makes sure that
    ranges are cut once only."""
    spark = df.sparkSession
    keys = [*(F.col(c) for c in within), *order]
    path = work_path(spark, "ranges")
    spread = df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    spread.write.parquet(path)
    rows = spark.read.schema(spread.schema).parquet(path)
    group = Window.partitionBy(*within) if within else Window
    counts = rows.groupBy("_range", *within).agg(F.count("*").alias("_n"))  # a row for each range and group in it
    before = counts.select(F.col("_range").alias("_r"), *(F.col(c).alias(f"_w{i}") for i, c in enumerate(within)), F.coalesce(F.sum("_n").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("_range", *within).orderBy(*order)))
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_w{i}")) for i, c in enumerate(within)], F.col("_range") == F.col("_r"))
    return inside.join(before, same).select(*df.columns, (F.col("_rn") + F.col("_before")).cast("long").alias("position"))


def batched(df: DataFrame, size: int, *order) -> DataFrame:
    """df with position (from 1) in the order and batch = (position - 1) div size."""
    return positioned(df, list(order)).withColumn("batch", F.floor((F.col("position") - 1) / size).cast("long"))


def sort_modes(df: DataFrame, group: str, modes: dict[str, list]) -> DataFrame:
    """df with a column for each mode: the place of a row in its group in that order."""
    for name, order in modes.items():
        df = positioned(df, order, (group,)).withColumnRenamed("position", name)
    return df


#: Places in a block of a long group.
BLOCK = 10_000


def _blocks(df: DataFrame, group: list[str], order: str, size: int, **totals: Column) -> tuple[DataFrame, DataFrame]:
    """df with its blocks of so many places, and one row with the totals of each block that has any."""
    cut = df.withColumn("_block", F.floor(F.col(order) / size))
    return cut, cut.groupBy(*group, "_block").agg(*(c.alias(n) for n, c in totals.items()))


def running(df: DataFrame, group: list[str], order: str, sums: dict[str, Column], maxima: dict[str, Column] | None = None, size: int = BLOCK) -> DataFrame:
    """df with sums and maxima of the expressions over the rows of the group so far, this one among them; 0 and null at first.

    order is a number that no two rows of a group share. Groups may be of any length: each is cut in blocks of ``size``
    places, the blocks' totals are carried on from one to the next, and no task sees more than a block or the totals."""
    maxima = maxima or {}
    cut, totals = _blocks(df, group, order, size, **{n: F.sum(c) for n, c in sums.items()}, **{n: F.max(c) for n, c in maxima.items()})
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*group, "_block", *(F.sum(n).over(before).alias(f"_{n}") for n in sums), *(F.max(n).over(before).alias(f"_{n}") for n in maxima))
    inside = Window.partitionBy(*group, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = cut.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()} | {n: F.max(c).over(inside) for n, c in maxima.items()})
    out = here.join(carry, [*group, "_block"])
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"_{n}"), F.lit(0)) for n in sums} | {n: F.greatest(F.col(n), F.col(f"_{n}")) for n in maxima}).drop("_block", *(f"_{n}" for n in (*sums, *maxima)))


def adjacent(df: DataFrame, group: list[str], order: str, value: Column, ring: bool = False, size: int = BLOCK) -> DataFrame:
    """df with ``previous`` and ``next``: the value of the rows before and after in the group, null at its ends or, in a ring,
    that of the other end. Groups are cut in blocks as in ``running``."""
    named = df.withColumn("_value", value)
    cut, ends = _blocks(named, group, order, size, _first=F.min_by(F.struct("_value"), order), _last=F.max_by(F.struct("_value"), order))
    line = Window.partitionBy(*group).orderBy("_block")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = ends.select(*group, "_block", F.lag("_last").over(line).alias("_before"), F.lead("_first").over(line).alias("_after"), F.first("_first").over(whole).alias("_head"), F.last("_last").over(whole).alias("_tail"))
    inside = Window.partitionBy(*group, "_block").orderBy(order)
    own = F.struct("_value")
    here = cut.withColumns({"_p": F.lag(own).over(inside), "_n": F.lead(own).over(inside)}).join(carry, [*group, "_block"])
    p, n = F.coalesce("_p", "_before", *(["_tail"] if ring else [])), F.coalesce("_n", "_after", *(["_head"] if ring else []))
    return here.select(*df.columns, p["_value"].alias("previous"), n["_value"].alias("next"))
