"""Registry of queries: (spark, sf_dir) to DataFrame, with the DuckDB SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks_for(rows: DataFrame, most: int = 20_000) -> int:
    """So many tasks that all cores have work, and none more than so many rows."""
    return max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // most))


def spread(rows: DataFrame, most: int = 20_000) -> DataFrame:
    """Narrow rows for work that takes long for each: over all cores, and at most so many in a task. A small file is one task
    whatever its rows, and adaptive execution would put a small shuffle together again if it had no number."""
    return rows.repartition(tasks_for(rows, most))


def rounded(c: Column, digits: int = 3) -> Column:
    """Half away from zero on decimals, so that every engine rounds alike."""
    return F.round(c.cast("decimal(28,9)"), digits).cast("double")


def rounded_sql(x: str, digits: int = 3) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"
