"""Distances, routes and galleries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayforge.operators.ranking import adjacent

EARTH_KM = 6371.0


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(a))


def loop_legs(stops: DataFrame, loop: str, pos: str, anchor: tuple[float, float]) -> DataFrame:
    """stops with leg_km: from each stop to the next, from the last one to the anchor, and start_km from the anchor to the first."""
    on = adjacent(stops, [loop], pos, F.struct("lat", "lng"))
    lat, lng = (F.coalesce(F.col("next")[c], F.lit(a)) for c, a in zip(("lat", "lng"), anchor))
    first = F.when(F.col("previous").isNull(), haversine(F.lit(anchor[0]), F.lit(anchor[1]), F.col("lat"), F.col("lng"))).otherwise(0.0)
    return on.withColumns({"leg_km": haversine(F.col("lat"), F.col("lng"), lat, lng), "start_km": first}).drop("previous", "next")


def bounding_box(points: DataFrame, anchor: tuple[float, float]) -> DataFrame:
    """One row (south, north, west, east) around points (lat, lng) and the anchor; points without coordinates are left out."""
    lat, lng = (F.lit(x) for x in anchor)
    ends = points.agg(F.min("lat").alias("a"), F.max("lat").alias("b"), F.min("lng").alias("c"), F.max("lng").alias("d"))
    return ends.select(F.least("a", lat).alias("south"), F.greatest("b", lat).alias("north"), F.least("c", lng).alias("west"), F.greatest("d", lng).alias("east"))


#: Latitudes and longitudes of the country.
COUNTRY = (45.7, 48.7, 16, 23)


def inside(lat: Column, lng: Column, box: tuple[float, float, float, float] = COUNTRY) -> Column:
    """Whether coordinates are in a box (south, north, west, east); missing ones, and ones that are no number, are not."""
    south, north, west, east = box
    return F.coalesce(lat.between(south, north) & lng.between(west, east), F.lit(False))


def unshown_beats(beats: DataFrame, subjects: DataFrame, by: list[str]) -> DataFrame:
    """The distinct beats of stories (columns ``by``) that no picture of the same stop shows."""
    return beats.select(*by).distinct().join(subjects.select(*by).distinct(), by, "left_anti")


def resolve_routes(routes: DataFrame, stops: DataFrame) -> DataFrame:
    """(loop, pos, stop_id, code) of route places (loop, pos, stop_id) whose stop is unknown, named twice among the stops, of
    another loop, or without valid coordinates."""
    known = stops.groupBy("stop_id").agg(F.count("*").alias("_n"), F.min("loop").alias("_loop"), F.min("lat").alias("_lat"), F.min("lng").alias("_lng"))
    valid = F.col("_lat").between(-90, 90) & F.col("_lng").between(-180, 180)
    out = routes.join(known, "stop_id", "left")
    code = F.when(F.col("_n").isNull(), "unknown").when(F.col("_n") > 1, "duplicate").when(F.col("_loop") != F.col("loop"), "other-loop").when(~F.coalesce(valid, F.lit(False)), "coordinates")
    return out.select("loop", "pos", "stop_id", code.alias("code")).where("code is not null")


def circular_neighbours(df: DataFrame, group: str, pos: str, value: str) -> DataFrame:
    """(group, value, previous, next) in a ring."""
    return adjacent(df, [group], pos, F.col(value), ring=True).select(group, value, "previous", "next")


def gallery_issues(photos: DataFrame, stop: str, src: str, per_stop: int = 5, pattern: str = r"^images/[a-z0-9-]+\.webp$") -> DataFrame:
    """(stop, code): galleries of another size, bad paths, and sources used more than once anywhere."""
    sizes = photos.groupBy(stop).agg(F.count("*").alias("n")).where(F.col("n") != per_stop).select(stop, F.lit("size").alias("code"))
    paths = photos.where(~F.col(src).rlike(pattern)).select(stop, F.lit("path").alias("code")).distinct()
    used = photos.groupBy(src).agg(F.count("*").alias("n")).where("n > 1").select(src)
    twice = photos.join(used, src, "left_semi").select(stop, F.lit("repeated").alias("code")).distinct()
    return sizes.union(paths).union(twice)


def asset_issues(files: DataFrame, key: str, content: str, low: int, high: int, magic: bytes, most: int = 30 << 20) -> DataFrame:
    """(key, code) of binary assets of a wrong size, with wrong first bytes, or equal to another one; and one row with a
    null key if all together are larger than ``most``."""
    h = files.select(key, F.octet_length(content).alias("_n"), F.substring(content, 1, len(magic)).alias("_m"), F.sha2(content, 256).alias("_h"))
    same = h.groupBy("_h").agg(F.count("*").alias("_c"))
    codes = F.array_compact(F.array(F.when(~F.col("_n").between(low, high), F.lit("size")), F.when(F.col("_m") != F.lit(magic), F.lit("magic")), F.when(F.col("_c") > 1, F.lit("repeated"))))
    total = h.agg(F.sum("_n").alias("_s")).where(F.col("_s") > most).select(F.lit(None).cast(files.schema[key].dataType).alias(key), F.lit("total").alias("code"))
    return h.join(same, "_h").select(key, F.explode(codes).alias("code")).union(total)
