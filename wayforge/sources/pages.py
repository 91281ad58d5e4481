"""Page corpora: scans, the validity gate, freshness, embedded blocks, features and cards; strict JSON and mixed CSV."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayforge.functions.nested import described_nodes, percent_replaced, unescaped
from wayforge.session import work_path


def scan_files(spark: SparkSession, *paths: str, glob: str = "*.html", modified_after: str | None = None) -> DataFrame:
    """(path, length, fetched_at, html) of stored pages, in folders of any depth; files not changed after the time (UTC) are
    left out when the folders are listed. A column that is not used, html above all, is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    files = (files.option("modifiedAfter", modified_after) if modified_after else files).load(list(paths))
    return files.select("path", "length", F.col("modificationTime").alias("fetched_at"), F.col("content").cast("string").alias("html"))


def newest_files(spark: SparkSession, path: str, key: str, version: str = "", glob: str = "*.html", as_of: Column | None = None, hours: int = 24, mode: str = "normal") -> DataFrame:
    """(key, path, length, fetched_at, html): of the files whose path has a key (group 1 of the pattern), the newest of each,
    by the number in group 1 of ``version`` or else by time; the freshness of ``fresh`` is that of the time.

    All is chosen by what the listing knows; then the files chosen are opened and no other. Their paths go through the
    driver, which holds the paths of the whole folder anyway when Spark lists it."""
    listed = scan_files(spark, path, glob=glob).drop("html").withColumn("key", F.regexp_extract("path", key, 1)).where("key <> ''")
    rank = F.regexp_extract("path", version, 1).cast("long") if version else F.lit(0).cast("long")
    if as_of is not None or mode == "refresh":
        listed = fresh(listed.withColumn("_own", F.col("path")), "_own", "fetched_at", as_of if as_of is not None else F.current_timestamp(), hours, mode)
    chosen = listed.groupBy("key").agg(F.max(F.struct(rank.alias("_rank"), "fetched_at", "path")).alias("_m")).select("key", F.col("_m.path").alias("_path"))
    paths = [r["_path"] for r in chosen.select("_path").collect()]
    if not paths:
        return scan_files(spark, path, glob=glob).limit(0).select(F.lit("").alias("key"), "path", "length", "fetched_at", "html")
    return scan_files(spark, *paths, glob=glob).select(F.regexp_extract("path", key, 1).alias("key"), "path", "length", "fetched_at", "html")


#: What a challenge page says, and what marks a page's own content.
CHALLENGE = ("captcha", "unusual traffic", "verify you are human")
MARKUP = r"<article|<main|itemtype=|\"@type\"\s*:\s*\"(?:localbusiness|product|touristattraction)\""


def gate(pages: DataFrame, html: str = "html", least: int = 30_000, markers: tuple[str, ...] = CHALLENGE, requested: str | None = None, canonical: str | None = None) -> DataFrame:
    """Detail pages with reject_reason, null for valid ones; the first reason that holds counts.

    With ``requested`` and ``canonical``, columns of addresses, the page must be the one that was asked for."""
    c = F.col(html)
    low = F.lower(c)
    reason = (
        F.when(c.isNull() | (F.octet_length(c) < least), "too-short").when(~F.contains(low, F.lit("<html")), "no-html")
        .when(low.rlike("|".join(markers)), "challenge").when(~low.rlike(MARKUP), "no-semantic-markup")
    )
    if requested and canonical:
        reason = reason.when(~identity(F.col(canonical)).eqNullSafe(identity(F.col(requested))), "identity")
    return pages.withColumn("reject_reason", reason.when(~low.rlike(r"<title>[^<]|name=\"description\"|class=\"review"), "no-content"))


def list_gate(pages: DataFrame, html: str = "html", least: int = 50_000, card: str = 'class="card') -> DataFrame:
    """List pages with reject_reason: they must be long enough and hold a card."""
    c = F.col(html)
    return pages.withColumn("reject_reason", F.when(c.isNull() | (F.octet_length(c) <= least), "too-short").when(~F.contains(c, F.lit(card)), "no-card"))


#: Types of linked data that describe a place or an offer.
PLACE_TYPES = "(?i)Product|TouristAttraction|LocalBusiness|Thing"


def best_description(pages: DataFrame, key: str, html: str, about: str, id_: Column) -> DataFrame:
    """(key, description, source): the longest text that the pattern ``about`` finds; else, of the objects in linked data
    whose @id, url or name holds the page's own id (digits), the longest description, first of objects of a place's type; else
    the longest meta description. Scripts that are no JSON have nothing. Pages without any description are left out."""
    clean = lambda t: F.trim(F.regexp_replace(t, r"(?U)\s+", " "))
    longest = lambda texts: F.array_max(F.filter(F.transform(texts, lambda t: F.struct(F.length(clean(t)).alias("n"), clean(t).alias("t"))), lambda x: x["n"] > 0))["t"]
    scripts = F.regexp_extract_all(html, F.lit(r"(?s)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1)
    own = pages.select(key, html, id_.cast("string").alias("_id"), described_nodes(scripts).alias("_linked"))
    fits = F.filter("_linked", lambda x: F.regexp_like(x["identity"], F.concat(F.lit("(?:^|[-d])"), F.col("_id"), F.lit("(?:-|$)"))))
    ranked = F.transform(fits, lambda x: F.struct(F.regexp_like(x["types"], F.lit(PLACE_TYPES)).alias("kind"), F.length(clean(x["description"])).alias("n"), clean(x["description"]).alias("t")))
    linked = F.array_max(F.filter(ranked, lambda x: x["n"] > 0))["t"]
    meta = F.regexp_extract_all(html, F.lit(r'<meta[^>]*name="description"[^>]*content="([^"]*)"'), 1)
    found = own.select(key, longest(F.regexp_extract_all(html, F.lit(about), 1)).alias("_a"), linked.alias("_b"), longest(meta).alias("_c"))
    source = F.when(F.col("_a").isNotNull(), "about").when(F.col("_b").isNotNull(), "linked-data").when(F.col("_c").isNotNull(), "meta")
    return found.select(key, F.coalesce("_a", "_b", "_c").alias("description"), source.alias("source")).where("description is not null")


def fresh(snapshots: DataFrame, key: str, at: str, as_of: Column, hours: int = 24, mode: str = "normal") -> DataFrame:
    """The newest snapshot of each key that may be reused: normal by age, refresh none, offline any."""
    if mode == "refresh":
        return snapshots.limit(0)
    kept = snapshots if mode == "offline" else snapshots.where(F.col(at) >= as_of - F.expr(f"interval {hours} hours"))
    others = [c for c in snapshots.columns if c != key]
    return kept.where(F.col(at) <= as_of).groupBy(key).agg(F.max(F.struct(at, *[c for c in others if c != at])).alias("_m")).select(key, "_m.*")


def embedded_blocks(pages: DataFrame, key: str, html: str, pattern: str, schema: str) -> DataFrame:
    """(key, n, item, error): the JSON array of the one block that pattern finds in each page; none or several are an error."""
    n = F.regexp_count(F.col(html), F.lit(pattern))
    found = pages.select(key, n.alias("n"), F.when(n == 1, F.from_json(F.regexp_extract(html, pattern, 1), schema)).alias("items"))
    return found.select(key, "n", F.explode_outer("items").alias("item"), F.when(F.col("n") != 1, "block-count").when(F.col("items").isNull(), "block-json").alias("error"))


def identity(url: Column) -> Column:
    """route:number of a page address, in small letters; else url:address."""
    route, number = F.regexp_extract(F.lower(url), r"://[^/]+/([a-z]+)/", 1), F.regexp_extract(F.lower(url), r"/([0-9]+)(?:[?#/]|$)", 1)
    return F.when((route != "") & (number != ""), F.concat_ws(":", route, number)).otherwise(F.concat(F.lit("url:"), url))


def host(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), r"^https?://([^/?#:]+)", 1)


def host_issues(urls: DataFrame, key: str, url: str, allowed: DataFrame, asset: str | None = None) -> DataFrame:
    """(key, code): addresses that are not https, or whose host is neither an allowed domain nor under one; with ``asset``,
    a column of addresses of files, also files of another host than their source."""
    own = host(F.col(asset)) if asset else host(F.col(url))
    h = urls.select(key, url, host(F.col(url)).alias("_h"), own.alias("_a"))
    parts = F.split("_h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    ok = h.select(key, F.explode(suffixes).alias("domain")).join(F.broadcast(allowed), "domain", "left_semi").select(key).distinct().withColumn("_ok", F.lit(True))  # the allow-list is a parameter
    out = h.join(ok, key, "left")
    codes = F.array_compact(F.array(F.when(~F.col(url).startswith("https://"), F.lit("scheme")), F.when(F.col("_ok").isNull(), F.lit("host")), F.when(~F.col("_a").eqNullSafe(F.col("_h")), F.lit("asset-host"))))
    return out.select(key, F.explode(codes).alias("code"))


class _Reader(HTMLParser):
    """Collects title, canonical link, description, headings, links and the text outside script and style."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.canonical, self.description, self.headings, self.links, self.text, self.skip, self.inside = "", None, None, [], [], [], 0, []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "a" and a.get("href"):
            self.links.append(a["href"])
        elif tag == "link" and a.get("rel") == "canonical":
            self.canonical = a.get("href")
        elif tag == "meta" and a.get("name") == "description":
            self.description = a.get("content")
        elif tag in ("title", "h1", "h2", "h3"):
            self.inside.append(tag)
            if tag != "title":
                self.headings.append("")
        if tag in ("br", "p", "div", "li", "tr", "h1", "h2", "h3"):
            self.text.append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif self.inside and tag == self.inside[-1]:
            self.inside.pop()

    def handle_data(self, data):
        if self.skip:
            return
        if self.inside[-1:] == ["title"]:
            self.title += data
        else:
            if self.inside:
                self.headings[-1] += data
            self.text.append(data)


FEATURES = "title string, canonical string, description string, headings array<string>, links array<string>, text string"


def features(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, FEATURES) of each page; a null page has empty ones."""
    kept = pages.select(key, html)
    out = T.StructType([kept.schema[key], *T.StructType.fromDDL(FEATURES).fields])
    strings = pa.list_(pa.string())
    kinds = [pa.string()] * 3 + [strings, strings, pa.string()]

    def run(batches):
        for batch in batches:
            rows = []
            for page in batch.column(1).to_pylist():
                r = _Reader()
                r.feed(page or "")
                r.close()
                rows.append((r.title.strip(), r.canonical, r.description, [" ".join(h.split()) for h in r.headings], r.links, " ".join("".join(r.text).split())))
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], out.names)

    return kept.mapInArrow(run, out)


def cards(pages: DataFrame, key: str, html: str, marker: str, escapes: bool = False) -> DataFrame:
    """(key, pos, link, name, photos, blurb): one row a card that the marker begins; cards without a name or link are dropped.

    A page is decoded three times: valid %XX escapes, one by one, and the references of <, > and &; with ``escapes`` also
    \\\\, \\" and \\/ of scripts. The first link is the identity; names and texts have all their references replaced; at
    most two photos, from before the reviews; a text of over 170 characters ends at a word, with an ellipsis."""
    pages = pages.select(key, F.col(html).alias("_d"))
    for _ in range(3):
        pages, decoded = percent_replaced(pages, "_d"), F.col("_d")
        for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), *((("\\\\", "\\"), ('\\"', '"'), ("\\/", "/")) if escapes else ())):
            decoded = F.replace(decoded, F.lit(a), F.lit(b))
        pages = pages.withColumn("_d", decoded)
    part = pages.select(key, F.posexplode(F.split("_d", F.lit(marker))).alias("pos", "card")).where("pos > 0")
    before = F.split("card", "class=\"review")[0]
    photos = F.slice(F.array_distinct(F.regexp_extract_all(before, F.lit(r'src="([^"]+)"'), 1)), 1, 2)
    out = part.select(key, "pos", F.regexp_extract("card", r'href="([^"]+)"', 1).alias("link"), F.regexp_extract("card", r">([^<>]{3,})<", 1).alias("_name"), photos.alias("photos"), F.regexp_replace(F.concat(F.lit("" if marker.endswith(">") else "<"), F.col("card")), "<[^>]*>?", " ").alias("_text"))
    out = out.where("_name <> '' and link <> ''").withColumns({"name": F.trim(unescaped(F.col("_name"))), "_text": F.trim(F.regexp_replace(unescaped(F.col("_text")), r"(?U)\s+", " "))})
    blurb = F.when(F.length("_text") <= 170, F.col("_text")).otherwise(F.concat(F.regexp_replace(F.substring("_text", 1, 168), r"(?s) [^ ]*\z", ""), F.lit("…")))
    return out.select(key, "pos", "link", "name", "photos", blurb.alias("blurb"))


def strict_json(spark: SparkSession, path: str, schema: str, key: str, one_list: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, issues) of a JSON list (or of one record a line): records that do not fit the schema, lack a string key or repeat one are issues.

    In a list, one record that does not fit spoils its whole file, as a parser cannot tell where the next one begins. What was
    parsed is written once, with all its columns, so that a record is judged by all of them wherever it is read."""
    full = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(full).option("multiLine", one_list).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    parsed = work_path(spark, "parsed")
    rows.write.parquet(parsed)
    rows = spark.read.schema(full).parquet(parsed)
    counts = rows.where(F.col(key).isNotNull() & F.col("_corrupt").isNull()).groupBy(key).agg(F.count("*").alias("n"))
    repeated = counts.where("n > 1").select(key, F.lit("duplicate-key").alias("code"))
    broken = rows.where(F.col("_corrupt").isNotNull() | F.col(key).isNull()).select(key, F.when(F.col("_corrupt").isNotNull(), "schema").otherwise("no-key").alias("code"))
    good = rows.where(F.col("_corrupt").isNull()).join(counts.where("n = 1").select(key), key, "left_semi").drop("_corrupt")
    return good, repeated.unionByName(broken)


def parse_details(df: DataFrame, details: str = "Details") -> DataFrame:
    """df with layout, rating, reviews, low, high, currency, category, lat, lng of a free text of parts split by " · "."""
    c = F.coalesce(F.trim(F.col(details)), F.lit(""))
    parts = F.split(c, " · ")
    coordinates = r"^(-?[0-9]+\.[0-9]+), *(-?[0-9]+\.[0-9]+)$"
    rated = r"^([0-5][.,][0-9])(?:\(([0-9,.]+)\))?$"
    priced = F.get(F.filter(parts, lambda p: p.rlike("[€£$]|Ft ?[0-9]|[0-9] ?Ft")), F.lit(0))
    number = lambda s: F.expr(f"try_cast(regexp_replace({s}, '[^0-9]', '') as long)")
    out = df.withColumns({"_c": c, "_first": parts[0], "_p": priced, "_range": F.split(F.coalesce(priced, F.lit("")), "[–-]")})
    layout = F.when(c == "", "empty").when(c.rlike(coordinates), "coordinates").when(F.col("_first").rlike(rated), "rated").when(F.col("_p").isNotNull(), "priced").otherwise("address")
    others = F.filter(F.slice(parts, 2, 9), lambda p: ~p.rlike("[€£$]|Ft ?[0-9]|[0-9] ?Ft"))
    return out.select(
        *df.columns, layout.alias("layout"), F.when(layout == "rated", F.replace(F.regexp_extract("_first", rated, 1), F.lit(","), F.lit(".")).cast("decimal(2,1)")).alias("rating"),
        F.when(layout == "rated", F.expr("try_cast(regexp_replace(regexp_extract(_first, '\\\\(([0-9,.]+)\\\\)', 1), '[^0-9]', '') as long)")).alias("reviews"),
        number("get(_range, 0)").alias("low"), F.when(~F.coalesce(F.col("_p"), F.lit("")).rlike(r"\+$"), number("get(_range, 1)")).alias("high"),
        F.when(F.col("_p").contains("€"), "EUR").when(F.col("_p").contains("£"), "GBP").when(F.col("_p").contains("$"), "USD").when(F.col("_p").contains("Ft"), "HUF").alias("currency"),
        F.when(layout == "rated", F.get(others, F.lit(0))).alias("category"),
        F.when(layout == "coordinates", F.regexp_extract("_c", coordinates, 1).cast("double")).alias("lat"), F.when(layout == "coordinates", F.regexp_extract("_c", coordinates, 2).cast("double")).alias("lng"),
    )
