"""Views of the driver tables that stand for the catalog's entities, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayforge.operators import feeds
from wayforge.plans.registry import read


def listing(spark: SparkSession, d: str) -> DataFrame:
    """A part as a listing: reviews and rating from its order lines."""
    lines = read(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("reviews"), F.sum(F.col("l_quantity").cast("bigint")).alias("_sum"))
    part = read(spark, d, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_type").alias("category"), F.col("p_brand").alias("city"), F.col("p_size").alias("size"))
    return part.join(lines, F.col("key") == F.col("l_partkey")).select("key", "name", "category", "city", "size", "reviews", (F.col("_sum") / F.col("reviews") / 10).alias("rating"))


LISTING = """listing AS (
    SELECT p_partkey AS key, p_name AS name, p_type AS category, p_brand AS city, p_size AS size, n AS reviews, s / n / 10 AS rating
    FROM part JOIN (SELECT l_partkey, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS s FROM lineitem GROUP BY 1) ON l_partkey = p_partkey
)"""


def feed(spark: SparkSession, d: str) -> DataFrame:
    """Events as listing feeds, one for each type."""
    events = read(spark, d, "events").select(F.col("event_type").alias("category"), F.col("user_id").alias("identity"), "ts", "event_id")
    return feeds.paged(events, "category", "ts", "event_id").select("category", "identity", "pos", "page")


FEED = """feed AS (
    SELECT category, identity, pos, (pos - 1) // 30 AS page
    FROM (SELECT event_type AS category, user_id AS identity, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS pos FROM events)
)"""


def strengths(spark: SparkSession, d: str) -> DataFrame:
    """(identity, reviews, score) of the feeds' identities, from all their events."""
    return read(spark, d, "events").groupBy(F.col("user_id").alias("identity")).agg(F.count("*").alias("reviews")).withColumn("score", (F.col("identity") % 41) / 10 + 1)


STRENGTHS = "strengths AS (SELECT user_id AS identity, count(*) AS reviews, (user_id % 41) / 10 + 1 AS score FROM events GROUP BY 1)"


def feed_pages(spark: SparkSession, d: str) -> DataFrame:
    """(category, page, new, unique_so_far, strong), the input of the depth decision."""
    f = feed(spark, d)
    tail = feeds.tail_strength(f.join(strengths(spark, d), "identity"), "category", (F.col("reviews") >= 50) & (F.col("score") >= 3.0))
    return feeds.new_ids(f, "category", "identity").join(tail, ["category", "page"]).select("category", "page", "new", "unique_so_far", "strong")


NEW_IDS = """new_ids AS (
    SELECT category, page, rows, new, CAST(sum(new) OVER (PARTITION BY category ORDER BY page) AS BIGINT) AS unique_so_far
    FROM (SELECT category, page, count(*) AS rows, count(*) FILTER (k = 1) AS new
          FROM (SELECT *, row_number() OVER (PARTITION BY category, identity ORDER BY pos) AS k FROM feed) GROUP BY 1, 2)
)"""
TAILS = """tails AS (
    SELECT category, page, count(*) FILTER (reviews >= 50 AND score >= 3.0) AS strong
    FROM (SELECT *, row_number() OVER (PARTITION BY category, page ORDER BY pos DESC) AS back FROM feed JOIN strengths USING (identity))
    WHERE back <= 10 GROUP BY 1, 2
)"""
DECIDED = """decided AS (
    SELECT category, page, new, unique_so_far, strong,
           CASE WHEN lead(page) OVER (PARTITION BY category ORDER BY page) IS NULL THEN 'stop: last page' WHEN new = 0 THEN 'stop: no new ids'
                WHEN page + 1 >= 20 THEN 'stop: page cap' WHEN unique_so_far < 90 THEN 'go: too few' WHEN strong >= 2 THEN 'go: strong tail' ELSE 'stop: weak tail' END AS decision
    FROM new_ids JOIN tails USING (category, page)
)"""
