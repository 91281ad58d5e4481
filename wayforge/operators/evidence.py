"""Evidence records: ids of packages, prepared items, contexts, briefs, dates and hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayforge.functions import text as T
from wayforge.functions.nested import json_nodes, values_named

#: The most reviews of an item, and the longest of its texts.
REVIEWS, REVIEW_CHARS, DESCRIPTION_CHARS = 10, 1800, 6000
#: A claim on money in evidence, which is left out of what is read.
CLAIM = r"(?i)(?:[$€£¥]\s*\d(?:[\d.,]*\d)?|\d(?:[\d.,]*\d)?\s*[$€£¥]|\b(?:USD|EUR|GBP|HUF)\s*\d(?:[\d.,]*\d)?|\d(?:[\d.,]*\d)?\s*(?:USD|EUR|GBP|HUF|dollars?|euros?|forints?|pounds?)\b)"


def redacted(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), CLAIM, "[price listed separately]")


def package_id(given: Column, index: Column, *identity: Column) -> Column:
    """The given id if it has the right form, else the start of a hash of the package's place and identity."""
    made = F.concat(F.lit("pkg-"), F.substring(F.sha2(F.concat_ws("|", index.cast("string"), *(F.coalesce(c.cast("string"), F.lit("")) for c in identity)), 256), 1, 16))
    return F.when(given.rlike(r"^[A-Za-z0-9._:-]{1,80}$"), given).otherwise(made)


def prepared(inventory: DataFrame, contexts: DataFrame, key: str) -> DataFrame:
    """Items of evidence: inventory (name, category, subtype, rating, review_count, url) first, the context (the same and
    description, checked_at, reviews array<struct<title, text, rating>>, packages array<struct<id, name, description,
    times>>) as fallback; texts without money and clipped at a sentence, or names cut, ten reviews, bodies that stand in a title moved, packages with ids."""
    fields = ("name", "category", "subtype", "rating", "review_count", "url")
    c = contexts.select(key, *(F.col(f).alias(f"_{f}") for f in fields), "description", "checked_at", "reviews", "packages")
    clean = lambda x: T.squeezed(redacted(x))
    plain = lambda x, most: T.cut(redacted(x), most)

    # each step is bound to a variable of its own: a lambda makes anew whatever it names twice
    def clean_review(r: Column) -> Column:
        return F.struct(clean(r["title"]).alias("title"), clean(r["text"]).alias("text"), r["rating"].alias("rating"))

    def clip_review(r: Column) -> Column:
        return F.struct(T.clipped_squeezed(r["title"], REVIEW_CHARS).alias("title"), T.clipped_squeezed(r["text"], REVIEW_CHARS).alias("text"), r["rating"].alias("rating"))

    def place_review(r: Column) -> Column:
        title, text = r["title"], r["text"]
        moved = (text == "") & ((F.length(title) > 120) | (F.size(F.split(title, " ")) >= 20))
        return F.struct(F.when(moved, "").otherwise(T.cut(title, 300)).alias("title"), F.when(moved, title).otherwise(text).alias("text"), r["rating"].alias("rating"))

    def package(p: Column, i: Column) -> Column:
        name = F.when(F.coalesce(p["name"], F.lit("")) == "", F.concat(F.lit("Option "), (i + 1).cast("string"))).otherwise(p["name"])
        return F.struct(package_id(p["id"], i, p["name"], p["description"], p["times"]).alias("id"), plain(name, 200).alias("name"), plain(p["description"], 1000).alias("description"), plain(T.cut(p["times"], 400), 400).alias("conditions"))

    out = inventory.join(c, key)
    most = {"name": 300, "category": 200, "subtype": 300}
    own = lambda f: F.coalesce(F.col(f), F.col(f"_{f}"))
    reviews = F.transform(F.transform(F.transform(F.slice("reviews", 1, REVIEWS), clean_review), clip_review), place_review)
    return out.select(key, *((T.cut(own(f), most[f]) if f in most else own(f)).alias(f) for f in fields), "checked_at", F.get(F.transform(F.array(clean(F.col("description"))), lambda x: T.clipped_squeezed(x, DESCRIPTION_CHARS)), F.lit(0)).alias("description"), reviews.alias("reviews"), F.transform("packages", package).alias("packages"))


def contexts(listings: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """listings (name, ...) with their parsed details (page_title, description, ...); a name that is only "the" gives way to
    a page title of several words, without quotation marks."""
    out = listings.join(details, key, "left")
    title = F.trim(F.regexp_replace("page_title", "[\"“”]", ""))
    cut = (F.lower(F.trim("name")) == "the") & (F.size(F.split(title, r"\s+")) > 1)
    return out.withColumn("name", F.when(F.coalesce(cut, F.lit(False)), title).otherwise(F.trim("name")))


def briefs(outputs: DataFrame, contexts_: DataFrame, key: str, page: str = "activity page") -> DataFrame:
    """outputs (what, do, why, research, reviews_used, review_summary) as briefs: source, label, check date, and fields on
    reviews only where reviews were used."""
    out = outputs.join(contexts_.select(key, F.coalesce("canonical_url", "url").alias("source"), "checked_at"), key)
    used = F.coalesce(F.col("reviews_used") > 0, F.lit(False))
    label = F.when(used, f"{page} + sampled reviews").otherwise(page)
    return out.select(key, "what", "do", "why", "research", "source", label.alias("source_label"), "checked_at", F.when(used, F.col("review_summary")).alias("review_summary"), F.when(used, F.col("reviews_used")).alias("reviews_used"), F.when(used, F.col("source")).alias("review_source"))


def checked_on(embedded: Column, fetched_live: Column, today: Column, file_time: Column) -> tuple[Column, Column]:
    """(date, provenance): the UTC date in the evidence, else today's if it was fetched live, else the file's."""
    live = F.when(fetched_live, today)
    return F.coalesce(embedded, live, file_time.cast("date")), F.when(embedded.isNotNull(), "embedded").when(live.isNotNull(), "live").otherwise("file")


def publication_hash(version: int, **fields: Column) -> Column:
    """SHA-256 of all that a reader can see: the item's hash, raw pricing, clipped description, curated record if any."""
    from wayforge.operators.publish import canonical_hash

    return canonical_hash(version, **fields)


#: The names of ids in answers, and what an address of a detail page looks like.
ID_NAMES = ("locationId", "detailId", "contentId")
DETAIL_LINK = r"(?i)/(?:[a-z]+_)?[a-z]+-g[0-9]+-d([0-9]+)-"


def nested_identities(document: Column) -> Column:
    """All ids in a JSON document, at any depth: values of ID_NAMES that are texts or whole numbers, and those in addresses of
    details inside any text; each once, sorted. What only looks like an id inside of a text is none."""
    nodes = json_nodes(F.array(document))
    whole = F.filter(nodes, lambda x: (x["kind"] == "string") | ((x["kind"] == "number") & x["value"].rlike("^-?[0-9]+$")))
    links = F.flatten(F.transform(F.filter(nodes, lambda x: x["kind"] == "string"), lambda x: F.regexp_extract_all(x["value"], F.lit(DETAIL_LINK), 1)))
    return F.array_sort(F.array_distinct(F.concat(values_named(whole, ID_NAMES), links)))
