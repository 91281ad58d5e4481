"""Mixing sources to target weights: iterative proportional fitting of token weights, then calibrated sampling."""

from __future__ import annotations

import functools
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayforge.llm.common import Staging, columns_of, row_hash

#: Cells raked on the driver; a larger table of cells is raked by Spark.
MAX_CELLS = 200_000


def cell_key(c: Column) -> Column:
    """A value of a dimension as text, in which null is a value that no text is."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def token_count(text: str = "text") -> Column:
    """Runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def cells_of(docs: DataFrame, dims: list[str]) -> DataFrame:
    """Token and document sums of each combination of the dimensions' values."""
    return docs.groupBy(*dims).agg(F.sum("tokens").cast("double").alias("tokens"), F.count("*").alias("docs"))


def smoothed_targets(cells: DataFrame, powers: dict[str, float]) -> dict[str, DataFrame]:
    """Marginals to aim at: every value's share of tokens raised to a power under 1, which lifts rare values."""
    out = {}
    for dim, power in powers.items():
        shares = cells.groupBy(dim).agg(F.sum("tokens").alias("t")).where("t > 0").withColumn("t", F.pow("t", F.lit(power)))
        out[dim] = shares.crossJoin(F.broadcast(shares.agg(F.sum("t").alias("total")))).select(dim, (F.col("t") / F.col("total")).alias("share"))
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = 60, tolerance: float = 1e-6, max_cells: int = MAX_CELLS) -> DataFrame:
    """cells with ``weight``: the factor on tokens under which every dimension's marginal has its target shares.

    cells: one row per combination with ``tokens``; targets: per dimension a table (dimension, share). A value without
    a target, or whose target is not positive, gets weight 0; a target whose value has no tokens is left out and the
    rest is scaled to 1. Targets that no weights meet (a value whose only combinations have weight 0) do not settle; after
    ``rounds`` rounds the last weights are returned with a warning. A table of over max_cells combinations is raked by
    grouping and joining in Spark, which gives the same weights. An empty table gives no rows."""
    spark, dims = cells.sparkSession, list(targets)
    if cells.limit(max_cells + 1).count() > max_cells:
        return _rake_joined(cells, targets, rounds, tolerance)
    frame = cells.toPandas()
    weight = np.ones(len(frame))
    tokens = frame["tokens"].to_numpy(float) if len(frame) else np.zeros(0)
    total, fits = tokens.sum(), []
    for dim in dims:
        share = {r[dim]: float(r["share"] or 0) for r in targets[dim].join(F.broadcast(cells.select(dim).distinct()), dim).collect()}
        values = sorted(share)
        index = frame[dim].map({v: i for i, v in enumerate(values)}).to_numpy(float) if len(frame) else np.zeros(0)
        weight[np.isnan(index)] = 0
        fits.append((np.nan_to_num(index).astype(int), np.asarray([max(share[v], 0) for v in values] or [0.0])))
    worst = 0.0
    for _ in range(rounds):
        worst = 0.0
        for index, share in fits:
            have = np.bincount(index, weight * tokens, len(share))
            aim = np.where(have > 0, share, 0)
            aim = aim * (total / aim.sum() if aim.sum() else 0)
            factor = np.divide(aim, have, out=np.zeros_like(aim), where=have > 0)
            worst = max(worst, float(np.abs(aim - have).max(initial=0)) / max(total, 1))
            weight = weight * factor[index]
        if worst < tolerance:
            break
    _settled(worst, tolerance, rounds)
    frame["weight"] = weight
    return spark.createDataFrame([tuple(r) for r in frame.itertuples(index=False)], cells.select("*", F.lit(0.0).alias("weight")).schema)


def _settled(worst: float, tolerance: float, rounds: int) -> None:
    if worst >= tolerance:
        warnings.warn(f"the marginals are off by {worst:.2g} of all tokens after {rounds} rounds", stacklevel=3)


def _rake_joined(cells: DataFrame, targets: dict[str, DataFrame], rounds: int, tolerance: float) -> DataFrame:
    staging = Staging(cells.sparkSession, "rake")
    now = staging.keep(cells.withColumn("weight", F.lit(1.0)), "cells")
    total, worst = now.agg(F.sum("tokens")).first()[0] or 0.0, 0.0
    for _ in range(rounds):
        worst = 0.0
        for dim, target in targets.items():
            have = now.groupBy(dim).agg(F.sum(F.col("weight") * F.col("tokens")).alias("_have")).where("_have > 0").join(target.where("share > 0"), dim)
            have = staging.keep(have, "marginal")
            scale = have.agg(F.sum("share")).first()[0] or 1.0
            aim = F.col("share") * (total / scale)
            worst = max(worst, (have.agg(F.max(F.abs(aim - F.col("_have")))).first()[0] or 0.0) / max(total, 1))
            factor = have.select(dim, (aim / F.col("_have")).alias("_factor"))
            then = staging.keep(now.join(factor, dim, "left").withColumn("weight", F.col("weight") * F.coalesce("_factor", F.lit(0.0))).drop("_factor"), "cells")
            staging.drop(now, have)
            now = then
        if worst < tolerance:
            break
    _settled(worst, tolerance, rounds)
    return now


def scale_for(cells: DataFrame, budget: float | None) -> float:
    """The factor c for which sum(tokens * min(1, c * weight)) is the budget; without one, the largest c that caps no cell."""
    top = cells.where("tokens > 0").agg(F.max("weight")).first()[0] or 0.0
    if top <= 0:
        return 0.0
    if budget is None:
        return 1.0 / top
    low, high = 0.0, 1.0 / top
    expected = lambda c: cells.agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * c))).first()[0] or 0.0
    for _ in range(40):
        if expected(high) >= budget or high > 1e12:
            break
        low, high = high, high * 2
    for _ in range(30):
        middle = (low + high) / 2
        low, high = (middle, high) if expected(middle) < budget else (low, middle)
    return high


def mix_to_targets(docs: DataFrame, powers: dict[str, float], targets: dict[str, DataFrame] | None = None, budget: float | None = None, seed: int = 17) -> DataFrame:
    """docs (with ``tokens`` and the dimensions in powers) plus ``weight``, ``probability`` and ``sampled``.

    A null value of a dimension is a value of its own, different from any text. A document is sampled if a hash of its id,
    in [0, 1), is under its cell's probability, so a rerun samples the same ones, and rows that repeat an id together; a
    null id is hashed with the row. Cells without tokens get probability 1 where no weight forbids them, as they change
    no marginal. An empty table gives no rows. Columns named weight, probability or sampled are replaced; others may have
    any names."""
    dims = list(powers)
    made = ("weight", "probability", "sampled")
    names = [f"_d{i}" for i in range(len(dims))]
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.lit(seed), F.col("doc_id"))).otherwise(row_hash(docs.drop(*made), F.lit(seed)))
    keyed = docs.select(F.struct(*columns_of(docs, *made)).alias("_row"), F.col("tokens"), key.alias("_key"), *(cell_key(F.col(d)).alias(n) for d, n in zip(dims, names)))
    staging = Staging(docs.sparkSession, "mixing")
    cells = staging.keep(cells_of(keyed, names), "cells")
    if targets:
        aims = {n: targets[d].select(cell_key(F.col(d)).alias(n), "share") for d, n in zip(dims, names)}
    else:
        aims = smoothed_targets(cells, {n: powers[d] for d, n in zip(dims, names)})
    raked = staging.keep(rake(cells, aims), "raked")
    c = scale_for(raked, budget)
    side = raked.select(*(F.col(n).alias(f"{n}r") for n in names), "weight", F.col("tokens").alias("_cell_tokens"))
    if raked.limit(MAX_CELLS + 1).count() <= MAX_CELLS:
        side = F.broadcast(side)  # at most MAX_CELLS rows
    probability = F.when(F.col("_cell_tokens") > 0, F.least(F.lit(1.0), F.col("weight") * c)).otherwise(F.lit(1.0))
    uniform = F.pmod(F.col("_key"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    same = functools.reduce(lambda a, b: a & b, [keyed[n] == F.col(f"{n}r") for n in names])
    out = keyed.join(side, same).select("_row", "weight", probability.alias("probability"), uniform.alias("_u"))
    return out.select("_row.*", "weight", "probability", (F.col("_u") < F.col("probability")).alias("sampled"))


def topic(text: str = "text") -> Column:
    """A coarse kind of text that stands for its topic: licensed, tabular, long or prose."""
    c = F.coalesce(F.col(text), F.lit(""))
    return F.when(c.rlike("(?i)licen[cs]e"), "licensed").when(c.contains(" | "), "tabular").when(F.length(c) > 10_000, "long").otherwise("prose")


#: How far the shares of sources, languages and topics are evened out.
POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """Weights, sampling probabilities and the sample of all documents for smoothed marginals."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", topic().alias("topic"), token_count().alias("tokens"))
    return mix_to_targets(Staging(spark, "op3").keep(docs, "tokens"), POWERS)  # texts are read once


def keep_mixture(spark, docs: DataFrame) -> DataFrame:
    """Pipeline stage: the documents sampled to the targets, with their own columns, whatever their names."""
    row = F.struct(*columns_of(docs)).alias("row")
    named = docs.select(row, "doc_id", "source", "lang", topic().alias("topic"), token_count().alias("tokens"))
    return mix_to_targets(named, POWERS).where("sampled").select("row.*")
