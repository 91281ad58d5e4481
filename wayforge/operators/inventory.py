"""Inventory rows: origins, visibility, gates, projections, requests, names, parties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def origin_class(place: Column, region: Column, own: str, allowed: tuple[str, ...]) -> Column:
    """own for the city's own place, region for one of the allowed regions, foreign for any other and for none."""
    return F.when(place == own, "own").when(region.isin(*allowed), "region").otherwise("foreign")


def visible(rows: DataFrame, hidden: DataFrame, key: str, city: str) -> DataFrame:
    """Rows (city, origin) of a city that are neither foreign nor hidden."""
    return rows.where((F.col("city") == city) & (F.col("origin") != "foreign")).join(hidden.select(key), key, "left_anti")


def quality_gates(rows: DataFrame, gates: dict[str, tuple[float, int]]) -> DataFrame:
    """One row: for each gate (least rating, least reviews) how many rows pass it, and how many there are."""
    test = lambda g: (F.col("rating") >= g[0]) & (F.col("reviews") >= g[1])
    return rows.agg(*(F.count_if(test(g)).alias(name) for name, g in gates.items()), F.count("*").alias("total"))


def run_summary(rows: DataFrame, group: str, **counts: Column) -> DataFrame:
    """Totals by group and over all (group ALL): rows, the conditions given, and the sum of reviews."""
    out = rows.rollup(group).agg(F.count("*").alias("total"), *(F.count_if(c).alias(name) for name, c in counts.items()), F.sum("reviews").alias("reviews"), F.grouping(group).alias("_all"))
    return out.withColumn(group, F.when(F.col("_all") == 1, "ALL").otherwise(F.col(group))).drop("_all")


def projected(rows: DataFrame, photos: str, primary: str, others: str) -> DataFrame:
    """rows (status new or dup): the new ones with img, the first photo or '', and cats, the primary and the other
    categories once each in order."""
    cats = F.array_distinct(F.array_prepend(F.coalesce(F.col(others), F.array().cast("array<string>")), F.col(primary)))
    return rows.where("status = 'new'").withColumns({"img": F.coalesce(F.get(photos, F.lit(0)), F.lit("")), "cats": cats})


def slug_keys(rows: DataFrame, name: str, image: Column) -> DataFrame:
    """rows with ``slug``: the first image's, else one made of the name."""
    from wayforge.functions.text import slug

    return rows.withColumn("slug", F.coalesce(image, slug(F.col(name))))


def repaired_names(rows: DataFrame, fixed: DataFrame, key: str, name: str) -> DataFrame:
    """rows with names from the override table (key, name), by identity and never by title, and ``repaired``."""
    f = fixed.select(key, F.col(name).alias("_fixed"))
    out = rows.join(f, key, "left")
    return out.withColumn("repaired", F.col("_fixed").isNotNull()).withColumn(name, F.coalesce("_fixed", name)).drop("_fixed")


def voted(votes: DataFrame, place: str, member: str, rating: str, least: int = 4) -> DataFrame:
    """(place, best, members): places that some member rated ``least`` or more, with the best rating and how many did."""
    each = votes.groupBy(place, member).agg(F.max(rating).alias("_r"))
    return each.groupBy(place).agg(F.max("_r").alias("best"), F.count_if(F.col("_r") >= least).alias("members")).where(F.col("best") >= least)


def evidence_ready(pricing: Column, checked_at: Column) -> Column:
    """Whether there is pricing evidence and its check has a date YYYY-MM-DD."""
    return pricing.isNotNull() & F.coalesce(checked_at.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))


def requested(requests: DataFrame, rows: DataFrame, limit: int | None = None) -> DataFrame:
    """(wanted, ord, key, state) of requests (ord, wanted) for keys or bare ids of rows (key, id), each once at the place
    of its first request: ok with the key, ambiguous if a bare id matches several keys, or missing. With a limit, the
    first ``limit`` keys that are ok follow in the order of their requests."""
    first = requests.groupBy("wanted").agg(F.min("ord").alias("ord"))
    names = rows.select(F.col("key").alias("wanted"), "key").union(rows.select(F.col("id").cast("string").alias("wanted"), "key"))
    found = names.groupBy("wanted").agg(F.count_distinct("key").alias("_n"), F.min("key").alias("_key"))
    state = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "ambiguous").otherwise("ok")
    out = first.join(found, "wanted", "left").select("wanted", "ord", F.when(F.col("_n") == 1, F.col("_key")).alias("key"), state.alias("state"))
    if limit is None:
        return out
    once = out.where("state = 'ok'").groupBy("key").agg(F.min("ord").alias("ord"))
    return once.orderBy("ord").limit(limit)


def group_floors(rows: DataFrame, floors: DataFrame, group: str, whole: int) -> DataFrame:
    """(group, least, n, below) for each floor (group, least), and for the whole inventory as group '*'."""
    counts = rows.groupBy(group).agg(F.count("*").alias("n"))
    each = floors.join(counts, group, "left").select(group, "least", F.coalesce("n", F.lit(0)).alias("n"))
    every = rows.agg(F.count("*").alias("n")).select(F.lit("*").alias(group), F.lit(whole).alias("least"), "n")
    return each.unionByName(every).withColumn("below", F.col("n") < F.col("least"))


def corroborated(rows: DataFrame, place: Column, source: str, least: int = 2) -> DataFrame:
    """(place, sources, badge): how many sources name a place."""
    return rows.groupBy(place.alias("place")).agg(F.count_distinct(source).alias("sources")).withColumn("badge", F.col("sources") >= least)


def duplicate_ids(rows: DataFrame, id_: Column, owner: str) -> DataFrame:
    """(id, first_owner, second_owner, n) of ids with several owners; the two smallest of all, in one pass."""
    each = rows.select(id_.alias("id"), F.col(owner).alias("_o")).distinct()
    two = each.groupBy("id").agg(F.expr("min_by(_o, _o)").alias("first_owner"), F.count("*").alias("n"), F.max("_o").alias("_max")).where("n > 1")
    rest = each.join(two, "id").where("_o > first_owner").groupBy("id", "first_owner", "n").agg(F.min("_o").alias("second_owner"))
    return rest.select("id", "first_owner", "second_owner", "n")


def party_text(counts: DataFrame, bands: DataFrame, key: str, band: str, n: str) -> DataFrame:
    """(key, party): counts by age band as text, in the order of the bands (band, title, plural); a band without a title
    is left out. bands is a parameter of a few rows."""
    each = counts.join(F.broadcast(bands), band)
    text = F.concat_ws(" ", F.col(n).cast("string"), F.when(F.col(n) == 1, F.col("title")).otherwise(F.col("plural")))
    return each.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(band), text.alias("t")))).alias("_p")).select(key, F.array_join(F.transform("_p", lambda x: x["t"]), " and ").alias("party"))


def party_choice(bands: DataFrame, product: str) -> DataFrame:
    """(product, band, travellers): of bands (band, independent, is_adult, least, most) the first whose limits hold: those
    that may travel alone first, then adults, then by id. travellers is two, kept within the largest least and the
    smallest most."""
    n = F.greatest(F.least(F.lit(2), F.col("most")), F.col("least"))
    rank = F.row_number().over(Window.partitionBy(product).orderBy(~F.col("independent"), ~F.col("is_adult"), "band"))
    feasible = bands.where((F.col("most") >= F.col("least")) & (F.col("most") > 0))
    return feasible.withColumn("_k", rank).where("_k = 1").select(product, "band", n.alias("travellers"))


def preferred(rows: DataFrame, group: str, value: str, order: str, first: str = "en") -> DataFrame:
    """(group, value): the first value if offered, else that listed first."""
    return rows.where(F.col(value).isNotNull()).groupBy(group).agg(F.min_by(value, F.struct(F.col(value) != first, F.col(order))).alias(value))


def redirected(titles: DataFrame, meta: DataFrame, redirects: DataFrame, title: str) -> DataFrame:
    """titles with the columns of meta (title, ...) found by the title, blanks for underscores and in small letters, or
    through a redirect (title, target), and ``unresolved``."""
    plain = lambda c: F.lower(F.translate(c, "_", " "))
    m = meta.withColumn(title, plain(F.col(title)))
    alias = redirects.select(plain(F.col(title)).alias("_from"), plain(F.col("target")).alias(title)).join(m, title).drop(title).withColumnRenamed("_from", title)
    every = m.unionByName(alias).withColumn("_hit", F.lit(True))
    return titles.withColumn(title, plain(F.col(title))).join(every, title, "left").withColumn("unresolved", F.col("_hit").isNull()).drop("_hit")


def sentinels(rows: DataFrame, pinned: DataFrame, key: str, label: str) -> DataFrame:
    """(key, state) of pinned (key, label): ok, mismatch or missing. pinned is a parameter."""
    p = pinned.select(key, F.col(label).alias("_label"))
    found = rows.select(key, label).join(F.broadcast(p), key, "right")
    return found.select(key, F.when(F.col(label).isNull(), "missing").when(F.col(label) != F.col("_label"), "mismatch").otherwise("ok").alias("state"))


def verdict_tally(rows: DataFrame, verdict: str, stated: dict) -> DataFrame:
    """(verdict, n, stated, mismatch) of every verdict that occurs or is stated."""
    says = F.create_map(*(F.lit(x) for kv in stated.items() for x in kv))
    n = rows.groupBy(verdict).agg(F.count("*").alias("n"))
    every = n.select(verdict).union(n.sparkSession.createDataFrame([(k,) for k in stated], n.select(verdict).schema)).distinct()
    out = every.join(n, verdict, "left").select(verdict, F.coalesce("n", F.lit(0)).alias("n"), F.try_element_at(says, F.col(verdict)).alias("stated"))
    return out.withColumn("mismatch", ~F.col("n").eqNullSafe(F.col("stated")))
