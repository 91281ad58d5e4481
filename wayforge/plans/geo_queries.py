"""Queries on places, routes, galleries and assets. Suppliers get coordinates from their keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayforge.operators import geo
from wayforge.operators.ranking import positioned
from wayforge.plans.registry import query, read, rounded, rounded_sql

ANCHOR = (47.4979, 19.0402)
STOPS = "stops AS (SELECT s_suppkey AS stop_id, s_nationkey AS loop, s_suppkey AS pos, 45.0 + (s_suppkey * 7 % 41) / 10.0 AS lat, 15.5 + (s_suppkey * 3 % 81) / 10.0 AS lng FROM supplier)"
HAVERSINE = "2 * 6371.0 * asin(sqrt(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)))"


def stops(spark, d):
    k = F.col("s_suppkey")
    return read(spark, d, "supplier").select(k.alias("stop_id"), F.col("s_nationkey").alias("loop"), k.alias("pos"), (F.lit(45.0) + (k * 7 % 41) / 10.0).alias("lat"), (F.lit(15.5) + (k * 3 % 81) / 10.0).alias("lng"))


@query(f"WITH {STOPS} SELECT stop_id, {rounded_sql(HAVERSINE.format(a='47.4979', b='19.0402', c='lat', d='lng'), 2)} AS km FROM stops")
def distance_anchor(spark, d):
    """O-G1."""
    return stops(spark, d).select("stop_id", rounded(geo.haversine(F.lit(ANCHOR[0]), F.lit(ANCHOR[1]), F.col("lat"), F.col("lng")), 2).alias("km"))


@query(f"""WITH {STOPS}, n AS (SELECT *, coalesce(lead(lat) OVER w, 47.4979) AS lat2, coalesce(lead(lng) OVER w, 19.0402) AS lng2, row_number() OVER w AS rn FROM stops WINDOW w AS (PARTITION BY loop ORDER BY pos))
    SELECT loop, count(*) AS stops, {rounded_sql('sum(' + HAVERSINE.format(a='lat', b='lng', c='lat2', d='lng2') + ' + CASE WHEN rn = 1 THEN ' + HAVERSINE.format(a='47.4979', b='19.0402', c='lat', d='lng') + ' ELSE 0 END)', 2)} AS km FROM n GROUP BY 1""")
def loop_length(spark, d):
    """O-W14, O-G2."""
    return geo.loop_legs(stops(spark, d), "loop", "pos", ANCHOR).groupBy("loop").agg(F.count("*").alias("stops"), rounded(F.sum(F.col("leg_km") + F.col("start_km")), 2).alias("km"))


@query(f"WITH {STOPS} SELECT least(min(lat), 47.4979) AS south, greatest(max(lat), 47.4979) AS north, least(min(lng), 19.0402) AS west, greatest(max(lng), 19.0402) AS east FROM stops WHERE stop_id % 3 = 0")
def bounding_box(spark, d):
    """O-A18: of the visible points and the anchor."""
    return geo.bounding_box(stops(spark, d).where("stop_id % 3 = 0"), ANCHOR)


@query(f"WITH {STOPS} SELECT stop_id, lat BETWEEN 45.7 AND 48.7 AND lng BETWEEN 16 AND 23 AS valid FROM stops")
def coordinate_validity(spark, d):
    """O-Q15."""
    return stops(spark, d).select("stop_id", geo.inside(F.col("lat"), F.col("lng")).alias("valid"))


@query("""SELECT s_nationkey AS loop, pos, stop_id, code FROM (SELECT s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS pos, CASE WHEN s_suppkey % 10 = 0 THEN -s_suppkey - 1 WHEN s_suppkey % 10 = 1 THEN s_suppkey + 1 ELSE s_suppkey END AS stop_id FROM supplier) r
    LEFT JOIN (SELECT s_suppkey, s_nationkey AS nk FROM supplier) s ON s.s_suppkey = r.stop_id, LATERAL (SELECT CASE WHEN nk IS NULL THEN 'unknown' WHEN nk <> s_nationkey THEN 'other-loop' WHEN s_suppkey % 13 = 0 THEN 'coordinates' END AS code) c WHERE code IS NOT NULL""")
def route_resolve(spark, d):
    """O-J8: every place of a route is a stop of its loop with coordinates."""
    k = F.col("s_suppkey")
    named = F.when(k % 10 == 0, -k - 1).when(k % 10 == 1, k + 1).otherwise(k)
    routes = positioned(read(spark, d, "supplier").select(F.col("s_nationkey").alias("loop"), "s_suppkey", named.alias("stop_id")), [F.col("s_suppkey")], ("loop",)).select("loop", (F.col("position") - 1).alias("pos"), "stop_id")
    known = stops(spark, d).withColumn("lat", F.when(F.col("stop_id") % 13 == 0, None).otherwise(F.col("lat")))
    return geo.resolve_routes(routes, known)


@query("""SELECT p_type, p_partkey, coalesce(lag(p_partkey) OVER w, last_value(p_partkey) OVER f) AS previous, coalesce(lead(p_partkey) OVER w, first_value(p_partkey) OVER f) AS next FROM part
    WINDOW w AS (PARTITION BY p_type, p_brand ORDER BY p_partkey), f AS (PARTITION BY p_type, p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def circular_neighbours(spark, d):
    """O-W13: galleries are rings, here of parts of a type and brand."""
    part = read(spark, d, "part").withColumn("gallery", F.concat_ws("|", "p_type", "p_brand"))
    return geo.circular_neighbours(part, "gallery", "p_partkey", "p_partkey").select(F.substring_index("gallery", "|", 1).alias("p_type"), "p_partkey", "previous", "next")


@query(r"""WITH p AS (SELECT p_partkey // 5 AS stop, CASE WHEN p_partkey % 40 = 0 THEN 'images/' || p_name || '.webp' WHEN p_partkey % 33 = 0 THEN 'images/same.webp' ELSE 'images/p-' || p_partkey || '.webp' END AS src FROM part WHERE p_partkey % 101 <> 100)
    SELECT stop, 'size' AS code FROM p GROUP BY 1 HAVING count(*) <> 5 UNION ALL SELECT DISTINCT stop, 'path' FROM p WHERE NOT regexp_matches(src, '^images/[a-z0-9-]+\.webp$') UNION ALL SELECT DISTINCT stop, 'repeated' FROM p WHERE src IN (SELECT src FROM p GROUP BY 1 HAVING count(*) > 1)""")
def gallery_constraints(spark, d):
    """O-A14."""
    k = F.col("p_partkey")
    src = F.when(k % 40 == 0, F.concat(F.lit("images/"), F.col("p_name"), F.lit(".webp"))).when(k % 33 == 0, "images/same.webp").otherwise(F.concat(F.lit("images/p-"), k.cast("string"), F.lit(".webp")))
    return geo.gallery_issues(read(spark, d, "part").where("p_partkey % 101 <> 100").select(F.floor(k / 5).alias("stop"), src.alias("src")), "stop", "src")


@query("""WITH beats AS (SELECT p_partkey // 5 AS stop, unnest(string_split(p_name, ' ')) AS beat FROM part WHERE p_partkey % 5 = 0), subjects AS (SELECT p_partkey // 5 AS stop, unnest(string_split(p_name, ' ')) AS beat FROM part WHERE p_partkey % 5 > 0) SELECT stop, beat FROM beats EXCEPT SELECT stop, beat FROM subjects""")
def story_coverage(spark, d):
    """O-J9: beats of a story that no picture of its gallery shows."""
    words = read(spark, d, "part").select("p_partkey", F.floor(F.col("p_partkey") / 5).alias("stop"), F.explode(F.split("p_name", " ")).alias("beat"))
    return geo.unshown_beats(words.where("p_partkey % 5 = 0"), words.where("p_partkey % 5 > 0"), ["stop", "beat"])


@query("""WITH f AS (SELECT doc_id, text, octet_length(encode(text)) AS n FROM documents), c AS (SELECT *, count(*) OVER (PARTITION BY text) AS same FROM f)
    SELECT doc_id, code FROM (SELECT doc_id, 'size' AS code FROM c WHERE n NOT BETWEEN 300 AND 9000 UNION ALL SELECT doc_id, 'magic' FROM c WHERE text[1:2] <> 'Th' UNION ALL SELECT doc_id, 'repeated' FROM c WHERE same > 1 UNION ALL SELECT NULL, 'total' FROM (SELECT sum(n) AS s FROM f) WHERE s > 1048576)""")
def asset_audit(spark, d):
    """O-S13: size, first bytes and uniqueness of binary assets, here of texts as bytes."""
    return geo.asset_issues(read(spark, d, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content")), "doc_id", "content", 300, 9000, b"Th", 1 << 20)
