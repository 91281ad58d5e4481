"""Queries on ranking, feeds, facets and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayforge.operators import feeds, inventory, ranking
from wayforge.plans.registry import query, read, rounded, rounded_sql
from wayforge.plans.views import DECIDED, FEED, LISTING, NEW_IDS, STRENGTHS, TAILS, feed, feed_pages, listing

SCORE_SQL = rounded_sql("reviews / (reviews + 50) * rating + 50 / (reviews + 50) * 4.0")


def scored(spark, d):
    return listing(spark, d).withColumn("score", rounded(ranking.bayes_score(F.col("rating"), F.col("reviews"))))


@query(f"WITH {LISTING} SELECT key, name, reviews, {SCORE_SQL} AS score FROM listing ORDER BY score DESC, key")
def bayes_rank(spark, d):
    """O-A1, O-O1."""
    return scored(spark, d).select("key", "name", "reviews", "score").orderBy(F.desc("score"), "key")


@query(f"WITH {FEED} SELECT identity, category, page, pos FROM (SELECT *, row_number() OVER (PARTITION BY identity ORDER BY category, pos) AS k FROM feed) WHERE k = 1")
def first_wins_dedupe(spark, d):
    """O-W1."""
    return feeds.first_wins(feed(spark, d), "identity", "category").select("identity", "category", "page", "pos")


@query(f"""WITH {FEED}, each AS (SELECT identity, category, min(pos) AS pos FROM feed GROUP BY 1, 2),
    all_ AS (SELECT identity, list(category ORDER BY category, pos) AS a FROM each GROUP BY 1)
    SELECT identity, a[1] AS "primary", array_to_string(a[2:], ',') AS also FROM all_""")
def multi_membership(spark, d):
    """O-A2."""
    return feeds.memberships(feed(spark, d), "identity", "category").withColumn("also", F.array_join("also", ","))


@query(f"""WITH {FEED}, each AS (SELECT category, page, identity, min(pos) AS pos FROM feed GROUP BY 1, 2, 3)
    SELECT category, page, identity, page * 30 + row_number() OVER (PARTITION BY category, page ORDER BY pos) AS rank FROM each""")
def feed_rank(spark, d):
    """O-W2."""
    return feeds.feed_rank(feed(spark, d), "category", "identity")


@query(f"WITH {FEED}, {NEW_IDS} SELECT * FROM new_ids")
def page_new_ids(spark, d):
    """O-W3."""
    return feeds.new_ids(feed(spark, d), "category", "identity")


@query(f"WITH {FEED}, {STRENGTHS}, {TAILS} SELECT * FROM tails")
def tail_strength(spark, d):
    """O-W4."""
    return feed_pages(spark, d).select("category", "page", "strong")


@query(f"WITH {FEED}, {STRENGTHS}, {NEW_IDS}, {TAILS}, {DECIDED} SELECT *, min(page) FILTER (decision LIKE 'stop%') OVER (PARTITION BY category) AS stop_page FROM decided")
def depth_decision(spark, d):
    """O-W5."""
    decided = feeds.depth_decision(feed_pages(spark, d), "category")
    return decided.join(feeds.stop_pages(decided, "category"), "category", "left")


@query(f"""WITH {FEED}, {STRENGTHS}, {NEW_IDS}, {TAILS}, {DECIDED},
    islands AS (SELECT *, sum(CASE WHEN decision = 'stop: weak tail' THEN 0 ELSE 1 END) OVER (PARTITION BY category ORDER BY page) AS reset FROM decided)
    SELECT category, page, streak, streak >= 2 AS stop FROM (
        SELECT category, page, CAST(sum(CASE WHEN decision = 'stop: weak tail' THEN 1 ELSE 0 END) OVER (PARTITION BY category, reset ORDER BY page) AS BIGINT) AS streak FROM islands)""")
def weak_streak(spark, d):
    """O-W6."""
    return feeds.weak_streaks(feeds.depth_decision(feed_pages(spark, d), "category"), "category").select("category", "page", "streak", "stop")


@query(f"""WITH {LISTING} SELECT count(*) FILTER (rating >= 2.6 AND reviews >= 35) AS strong, count(*) FILTER (rating >= 2.4 AND reviews >= 25) AS fair, count(*) AS total FROM listing""")
def quality_gates(spark, d):
    """O-F2, thresholds scaled to this data."""
    return inventory.quality_gates(listing(spark, d), {"strong": (2.6, 35), "fair": (2.4, 25)})


@query(f"""WITH {LISTING} SELECT coalesce(city, 'ALL') AS city, count(*) AS total, count(*) FILTER (rating >= 2.5) AS rated, count(*) FILTER (size > 45) AS closed, CAST(sum(reviews) AS BIGINT) AS reviews
    FROM listing GROUP BY ROLLUP (city)""")
def run_summary_rollup(spark, d):
    """O-A15: per city and in total."""
    return inventory.run_summary(listing(spark, d), "city", rated=F.col("rating") >= 2.5, closed=F.col("size") > 45)


def origin(spark, d):
    """Parts with the nation and region of their first supplier."""
    nation, region = read(spark, d, "nation"), read(spark, d, "region")
    first = read(spark, d, "lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("s_suppkey"))
    places = read(spark, d, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))  # nation and region are fixed tables of 25 and 5 rows
    kind = inventory.origin_class(F.col("n_name"), F.col("r_name"), "NATION_3", ("EUROPE", "AFRICA"))
    return first.join(places, "s_suppkey").select(F.col("l_partkey").alias("key"), "n_name", "r_name", kind.alias("origin"))


ORIGIN = """origin AS (
    SELECT l_partkey AS key, n_name, r_name, CASE WHEN n_name = 'NATION_3' THEN 'own' WHEN r_name IN ('EUROPE', 'AFRICA') THEN 'region' ELSE 'foreign' END AS origin
    FROM (SELECT l_partkey, min(l_suppkey) AS s_suppkey FROM lineitem GROUP BY 1) JOIN supplier USING (s_suppkey)
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


@query(f"WITH {ORIGIN} SELECT * FROM origin")
def origin_class(spark, d):
    """O-P3."""
    return origin(spark, d)


@query(f"WITH {LISTING}, {ORIGIN} SELECT key, name, city, origin FROM listing JOIN origin USING (key) WHERE city = 'Brand#3' AND origin <> 'foreign' AND key NOT IN (SELECT p_partkey FROM part WHERE p_size > 45)")
def visible_inventory(spark, d):
    """O-F1: a city's rows that are neither foreign nor hidden."""
    hidden = read(spark, d, "part").where("p_size > 45").select(F.col("p_partkey").alias("key"))
    return inventory.visible(listing(spark, d).join(origin(spark, d), "key"), hidden, "key", "Brand#3").select("key", "name", "city", "origin")


@query("""SELECT p_partkey, p_type, p_brand FROM part WHERE p_type IN ('ECONOMY', 'PROMO') AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#7')
    AND len(list_intersect(string_split(p_name, ' '), ['red', 'blue', 'bolt'])) > 0""")
def faceted_filter(spark, d):
    """O-F3; words of the name are a facet of many values."""
    part = read(spark, d, "part").withColumn("tags", F.split("p_name", " "))
    return ranking.faceted(part, {"p_type": ["ECONOMY", "PROMO"], "p_brand": ["Brand#1", "Brand#2", "Brand#7"], "tags": ["red", "blue", "bolt"], "p_size": []}, many=("tags",)).select("p_partkey", "p_type", "p_brand")


@query("""SELECT 'p_type' AS facet, p_type AS value, count(*) AS n FROM part GROUP BY 2 UNION ALL SELECT 'p_brand', p_brand, count(*) FROM part GROUP BY 2
    UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), count(*) FROM part GROUP BY 2""")
def facet_values(spark, d):
    """O-F7."""
    return ranking.facet_values(read(spark, d, "part"), ["p_type", "p_brand", "p_size"])


@query(f"""WITH {LISTING} SELECT key, name, reviews, {rounded_sql('rating', 4)} AS rating, row_number() OVER (PARTITION BY city ORDER BY reviews DESC, rating DESC, name, key) AS by_sources,
    row_number() OVER (PARTITION BY city ORDER BY coalesce(rating, 0) DESC, name, key) AS by_rating FROM listing""")
def sort_modes(spark, d):
    """O-O2: both orders of each city's list."""
    modes = {"by_sources": [F.desc("reviews"), F.desc("rating"), "name", "key"], "by_rating": [F.desc(F.coalesce("rating", F.lit(0.0))), "name", "key"]}
    modes = {k: [F.col(c) if isinstance(c, str) else c for c in v] for k, v in modes.items()}
    out = ranking.sort_modes(listing(spark, d).select("key", "name", "reviews", "rating", "city"), "city", modes)
    return out.select("key", "name", "reviews", rounded(F.col("rating"), 4).alias("rating"), "by_sources", "by_rating")


CATEGORY_ORDER = [("STANDARD", 1), ("PROMO", 2), ("SMALL", 3), ("MEDIUM", 4), ("LARGE", 5), ("ECONOMY", 6), ("UNUSED", 7)]


@query("""SELECT p_type, ordinal, count(*) AS n, min(p_name) AS first_name FROM part JOIN
    (VALUES ('STANDARD', 1), ('PROMO', 2), ('SMALL', 3), ('MEDIUM', 4), ('LARGE', 5), ('ECONOMY', 6), ('UNUSED', 7)) AS o(p_type, ordinal) USING (p_type) GROUP BY 1, 2 ORDER BY 2""")
def primary_category_groups(spark, d):
    """O-O3."""
    order = spark.createDataFrame(CATEGORY_ORDER, "p_type string, ordinal int")
    return ranking.grouped_in_order(read(spark, d, "part"), "p_type", order, "p_name").orderBy("ordinal")


@query("""WITH votes AS (SELECT user_id % 2 AS member, CAST(floor(value) AS BIGINT) % 500 AS place, max(CAST(floor(value) AS BIGINT) % 6) AS rating FROM events GROUP BY 1, 2)
    SELECT place, max(rating) AS best, count(*) FILTER (rating >= 4) AS members FROM votes GROUP BY 1 HAVING max(rating) >= 4""")
def our_picks(spark, d):
    """O-F4: places that either member rated 4 or more."""
    whole = F.floor("value").cast("bigint")
    votes = read(spark, d, "events").select((F.col("user_id") % 2).alias("member"), (whole % 500).alias("place"), (whole % 6).alias("rating"))
    return inventory.voted(votes, "place", "member", "rating")


@query("""WITH requests AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS ord, CASE WHEN o_orderkey % 2 = 0 THEN 'r' || (o_custkey % 3) || ':' || (o_custkey % 1800) ELSE CAST(o_custkey % 1800 AS VARCHAR) END AS wanted FROM orders),
    firsts AS (SELECT wanted, min(ord) AS ord FROM requests GROUP BY 1), rows_ AS (SELECT 'r' || (c_custkey % 3) || ':' || (c_custkey % 1600) AS key, CAST(c_custkey % 1600 AS VARCHAR) AS id FROM customer),
    names AS (SELECT key AS wanted, key FROM rows_ UNION ALL SELECT id, key FROM rows_), found AS (SELECT wanted, count(DISTINCT key) AS n, min(key) AS key FROM names GROUP BY 1)
    SELECT wanted, ord, CASE WHEN n = 1 THEN key END AS key, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE 'ok' END AS state FROM firsts LEFT JOIN found USING (wanted)""")
def requested_selection(spark, d):
    """O-F6: requests once each, in their order; a bare id may match two keys or none."""
    bare = (F.col("o_custkey") % 1800).cast("string")
    wanted = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("r"), (F.col("o_custkey") % 3).cast("string"), F.lit(":"), bare)).otherwise(bare)
    requests = ranking.positioned(read(spark, d, "orders").select("o_orderkey", wanted.alias("wanted")), [F.col("o_orderkey")]).withColumnRenamed("position", "ord")
    id_ = F.col("c_custkey") % 1600
    rows = read(spark, d, "customer").select(F.concat(F.lit("r"), (F.col("c_custkey") % 3).cast("string"), F.lit(":"), id_.cast("string")).alias("key"), id_.alias("id"))
    return inventory.requested(requests, rows)


@query("""SELECT o_orderkey, o_orderstatus <> 'P' AND o_orderkey % 5 <> 0 AS ready FROM orders""")
def evidence_ready(spark, d):
    """O-F5: pricing is there and its check has a date."""
    day = F.when(F.col("o_orderkey") % 5 == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return read(spark, d, "orders").select("o_orderkey", inventory.evidence_ready(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")), day).alias("ready"))


@query("""SELECT l_partkey, l_returnflag, l_linestatus, l_orderkey, l_linenumber, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS pos FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey, l_returnflag, l_linestatus, l_quantity ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS k FROM lineitem) WHERE k = 1) WHERE pos <= 10""")
def top_reviews(spark, d):
    """O-W11: the first ten distinct reviews of each entity."""
    return ranking.top_unique(read(spark, d, "lineitem"), "l_partkey", ["l_returnflag", "l_linestatus", "l_quantity"], ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]).select("l_partkey", "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "pos")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def batch_limit(spark, d):
    """O-O4."""
    return read(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS position, (row_number() OVER (ORDER BY o_orderkey) - 1) // 8 AS batch FROM orders")
def fixed_batches(spark, d):
    """O-O5."""
    return ranking.batched(read(spark, d, "orders").select("o_orderkey"), 8, "o_orderkey")
