"""Queries on stored pages and their addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayforge.plans.registry import query, read
from wayforge.session import work_path
from wayforge.sources import pages as P

HOST_SQL = "regexp_extract(lower(url), '^https?://([^/?#:]+)', 1)"
IDENTITY_SQL = "CASE WHEN regexp_extract(lower(url), '://[^/]+/([a-z]+)/', 1) <> '' AND regexp_extract(lower(url), '/([0-9]+)(?:[?#/]|$)', 1) <> '' THEN regexp_extract(lower(url), '://[^/]+/([a-z]+)/', 1) || ':' || regexp_extract(lower(url), '/([0-9]+)(?:[?#/]|$)', 1) ELSE 'url:' || url END"


@query(f"SELECT page_id, octet_length(encode(html)) AS bytes, {HOST_SQL} AS host FROM pages")
def corpus_scan(spark, d):
    """O-S1."""
    return read(spark, d, "pages").select("page_id", F.octet_length("html").cast("long").alias("bytes"), P.host(F.col("url")).alias("host"))


@query("SELECT page_id, octet_length(encode(html)) AS bytes, (page_id % 16) % 3 AS version FROM pages")
def newest_files(spark, d):
    """O-S1, O-S3: pages in files of up to three versions; the newest file of each is chosen by its path, and alone opened."""
    root = work_path(spark, "stored-pages")
    pages = read(spark, d, "pages").withColumn("bucket", F.col("page_id") % 16).withColumn("version", F.explode(F.sequence(F.lit(0), F.col("bucket") % 3)))
    line = F.to_json(F.struct("page_id", F.concat("html", F.when(F.col("version") < F.col("bucket") % 3, "stale").otherwise("")).alias("html")))
    pages.select("bucket", "version", line.alias("line")).repartition("bucket", "version").write.partitionBy("bucket", "version").text(root)
    files = P.newest_files(spark, root, "/bucket=([0-9]+)/", "/version=([0-9]+)/", glob="*.txt")
    rows = files.select(F.regexp_extract("path", "/version=([0-9]+)/", 1).cast("long").alias("version"), F.explode(F.split("html", "\n")).alias("line")).where("line <> ''")
    page = F.from_json("line", "page_id long, html string")
    return rows.select(page["page_id"].alias("page_id"), F.octet_length(page["html"]).cast("long").alias("bytes"), "version")


@query(f"""SELECT page_id, 'detail' AS kind, CASE WHEN octet_length(encode(html)) < 1200 THEN 'too-short' WHEN NOT contains(lower(html), '<html') THEN 'no-html' WHEN regexp_matches(lower(html), 'captcha|unusual traffic|verify you are human') THEN 'challenge'
    WHEN NOT regexp_matches(lower(html), '<article|<main|itemtype=') THEN 'no-semantic-markup' WHEN page_id % 9 = 0 THEN 'identity' WHEN NOT regexp_matches(lower(html), '<title>[^<]') THEN 'no-content' END AS reject_reason FROM pages
    UNION ALL SELECT page_id, 'list', CASE WHEN octet_length(encode(html)) <= 3000 THEN 'too-short' WHEN page_id % 4 = 0 THEN 'no-card' END FROM pages""")
def page_gate(spark, d):
    """O-S2: pages as detail pages, every ninth with another's canonical address, and as list pages, one in four without a card."""
    i = F.col("page_id")
    pages = read(spark, d, "pages").withColumn("canonical", F.when(i % 9 == 0, F.lit("https://example.com/other/0")).otherwise(F.col("url")))
    detail = P.gate(pages, least=1200, requested="url", canonical="canonical").select("page_id", F.lit("detail").alias("kind"), "reject_reason")
    lists = pages.withColumns({"size": F.octet_length("html"), "html": F.concat("html", F.when(i % 4 == 0, "").otherwise('<div class="card">'))})
    lists = P.list_gate(lists, least=3000).select("page_id", F.lit("list").alias("kind"), F.when(F.col("size") <= 3000, "too-short").otherwise(F.col("reject_reason")).alias("reject_reason"))
    return detail.union(lists)


@query("""SELECT user_id, max(event_id) AS event_id, mode FROM (SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, 'normal' AS mode FROM events WHERE ts >= TIMESTAMP '2024-01-19 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1
    UNION ALL SELECT user_id, max_by(event_id, (ts, event_id)), 'offline' FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1) GROUP BY 1, 3""")
def fresh_snapshot(spark, d):
    """O-S3: normal and offline mode, as of a moment."""
    events, as_of = read(spark, d, "events").select("user_id", "ts", "event_id"), F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00"))
    mode = lambda m: P.fresh(events, "user_id", "ts", as_of, mode=m).select("user_id", "event_id", F.lit(m).alias("mode"))
    return mode("normal").unionByName(mode("offline"))


@query(f"SELECT page_id, {IDENTITY_SQL} AS identity FROM pages")
def page_identity(spark, d):
    """O-P1."""
    return read(spark, d, "pages").select("page_id", P.identity(F.col("url")).alias("identity"))


@query("""SELECT page_id, 'scheme' AS code FROM pages WHERE NOT starts_with(url, 'https://') UNION ALL SELECT page_id, 'host' FROM pages WHERE NOT regexp_matches(lower(url), '^https?://([^/?#:]+\\.)?example\\.(net|org)([/?#:]|$)') UNION ALL SELECT page_id, 'asset-host' FROM pages WHERE page_id % 6 = 5""")
def host_audit(spark, d):
    """O-X23."""
    allowed = spark.createDataFrame([("example.net",), ("example.org",)], "domain string")
    asset = F.when(F.col("page_id") % 6 == 5, "https://cdn.example/x.jpg").otherwise(F.concat(F.lit("https://"), P.host(F.col("url")), F.lit("/x.jpg")))
    return P.host_issues(read(spark, d, "pages").withColumn("asset", asset), "page_id", "url", allowed, "asset")


@query("SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS link FROM pages")
def page_links(spark, d):
    """O-X18: links, without a parser where a pattern is enough."""
    return read(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1)).alias("link"))


PLAIN = lambda x: f"regexp_replace(replace(replace(replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;?', '&', 'g')"
BARE = r"regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '(?s)<title>.*?</title>', '', 'g')"
TEXT_SQL = PLAIN(rf"regexp_replace(regexp_replace({BARE}, '<(br|p|div|li|tr|h1|h2|h3)(\s[^>]*)?/?>', ' ', 'g'), '<[^>]*>', '', 'g')")


@query(rf"""SELECT page_id, trim({PLAIN("regexp_extract(html, '<title>([^<]*)</title>', 1)")}) AS title, len(regexp_extract_all({BARE}, '<h[123][ >]')) AS headings, len(regexp_extract_all({BARE}, '<a href="[^"]+"')) AS links, trim(regexp_replace({TEXT_SQL}, '[\s\x{{00a0}}]+', ' ', 'g')) AS text FROM pages""")
def page_text(spark, d):
    """O-X18: features by the HTML kernel; the SQL has patterns for what these pages hold."""
    f = P.features(read(spark, d, "pages"), "page_id")
    return f.select("page_id", "title", F.size("headings").alias("headings"), F.size("links").alias("links"), "text")


BLOCK = r"const DATA=(\[.*?\]);"


@query("""SELECT page_id, CASE WHEN page_id % 6 = 0 THEN 0 WHEN page_id % 6 = 1 THEN 2 ELSE 1 END AS n, CASE WHEN page_id % 6 > 1 THEN 'p' || page_id || '-' || k END AS id, CASE WHEN page_id % 6 < 2 THEN 'block-count' END AS error
    FROM pages, (VALUES (1), (2)) AS v(k) WHERE page_id % 6 > 1 OR k = 1""")
def embedded_block(spark, d):
    """O-S6: each page carries none, one or two blocks made from its id."""
    i = F.col("page_id").cast("string")
    block = F.concat(F.lit('<script>const DATA=[{"id":"p'), i, F.lit('-1"},{"id":"p'), i, F.lit('-2"}];</script>'))
    k = F.col("page_id") % 6
    html = F.concat("html", F.when(k == 0, "").when(k == 1, F.concat(block, block)).otherwise(block))
    return P.embedded_blocks(read(spark, d, "pages").select("page_id", html.alias("html")), "page_id", "html", BLOCK, "array<struct<id: string>>").select("page_id", "n", "item.id", "error")


@query("""SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'The longer about ' || page_id WHEN 1 THEN 'A "great" tour of cafés ' || page_id WHEN 2 THEN 'Meta, the longest ' || page_id ELSE 'Meta' END AS description, CASE page_id % 5 WHEN 0 THEN 'about' WHEN 1 THEN 'linked-data' ELSE 'meta' END AS source FROM pages WHERE page_id % 5 <> 4""")
def best_description(spark, d):
    """O-X19: about, linked data of the page itself, meta; every fifth page has another set of them."""
    i = F.col("page_id").cast("string")
    k = F.col("page_id") % 5
    about = F.concat(F.lit('<div class="about">Short</div><div class="about">The longer\n about '), i, F.lit("</div>"))
    linked = lambda id_, text: F.concat(F.lit('<script type="application/ld+json">{"@graph":[{"@type":["Organization","Product"],"@id":"/Page-d'), id_, F.lit('-x","description":"'), text, F.lit('"},{"@type":"Review","about":"-d'), i, F.lit('-","description":"Only a mention of the page\'s id, which is longer"}]}</script>'))
    review = F.concat(F.lit('<script type="application/ld+json">{"@type":"Review","url":"/r-d'), i, F.lit('-x","description":"A longer text on the page, of a type that describes no place"}</script><script type="application/ld+json">{"broken</script>'))
    meta = lambda text: F.concat(F.lit('<meta name="description" content="'), text, F.lit('">'))
    more = (
        F.when(k == 0, F.concat(about, linked(i, F.lit("A linked description that is much longer than the others")))).when(k == 1, F.concat(linked(F.lit("x"), F.lit("Another page's description, longer")), linked(i, F.concat(F.lit(r'A \"great\" tour\n of caf\u00e9s '), i)), review, meta(F.lit("Meta"))))
        .when(k == 2, F.concat(linked(F.lit("0x"), F.lit("Another page's description")), meta(F.lit("Meta")), meta(F.concat(F.lit("Meta, the longest "), i)))).when(k == 3, meta(F.lit("Meta"))).otherwise("")
    )
    return P.best_description(read(spark, d, "pages").select("page_id", F.concat("html", more).alias("html")), "page_id", "html", r'(?s)<div class="about">(.*?)</div>', i)


@query(rf"""WITH p AS (SELECT page_id, {"replace(replace(replace(" * 3}html{", '&lt;', '<'), '&gt;', '>'), '&amp;', '&')" * 3} AS html FROM pages),
    c AS (SELECT page_id, unnest(string_split(html, '<li>')) AS card, generate_subscripts(string_split(html, '<li>'), 1) - 1 AS pos FROM p),
    f AS (SELECT page_id, pos, card, regexp_extract(card, 'href="([^"]+)"', 1) AS link, regexp_extract(card, '>([^<>]{{3,}})<', 1) AS name FROM c WHERE pos > 0),
    b AS (SELECT page_id, pos, link, trim({PLAIN("name")}) AS name, trim(regexp_replace({PLAIN("regexp_replace(card, '<[^>]*>?', ' ', 'g')")}, '[\s\x{{00a0}}]+', ' ', 'g')) AS t FROM f WHERE link <> '' AND name <> '')
    SELECT page_id, pos, link, name, CASE WHEN length(t) <= 170 THEN length(t) ELSE length(regexp_replace(t[1:168], '(?s) [^ ]*$', '')) + 1 END AS blurb FROM b
    UNION ALL SELECT page_id, -1, 'x/y', 'Café & béar', length('100% fun %zz Café & béar') FROM pages""")
def card_explode(spark, d):
    """O-X24: list items as cards, and one card a page whose text has a bare %, an escape that is none and double escapes."""
    pages = read(spark, d, "pages")
    planted = F.lit('<li class="odd">100% fun %zz <a href="x%252Fy">Caf%C3%A9 &amp;amp; b&eacute;ar</a></li>')
    first = P.cards(pages, "page_id", "html", "<li>")
    second = P.cards(pages.select("page_id", planted.alias("html")), "page_id", "html", '<li class="odd">').withColumn("pos", F.lit(-1))
    return first.unionByName(second).select("page_id", "pos", "link", "name", F.length("blurb").alias("blurb"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'rated' WHEN 1 THEN 'rated' WHEN 2 THEN 'priced' WHEN 3 THEN 'coordinates' WHEN 4 THEN 'address' ELSE 'empty' END AS layout, CASE p_partkey % 6 WHEN 0 THEN 4.5 WHEN 1 THEN 4.1 END::DOUBLE AS rating, CASE WHEN p_partkey % 6 < 2 THEN p_size * 37 END::BIGINT AS reviews,
    CASE p_partkey % 6 WHEN 1 THEN 10 WHEN 2 THEN 20000 END::BIGINT AS low, CASE p_partkey % 6 WHEN 1 THEN 20 END::BIGINT AS high, CASE p_partkey % 6 WHEN 1 THEN 'EUR' WHEN 2 THEN 'HUF' END AS currency, CASE p_partkey % 6 WHEN 0 THEN 'Museum' WHEN 1 THEN 'Cafe' END AS category, CASE p_partkey % 6 WHEN 3 THEN 47.4979 END::DOUBLE AS lat, CASE p_partkey % 6 WHEN 3 THEN 19.0402 END::DOUBLE AS lng FROM part""")
def details_csv(spark, d):
    """O-S5: details made from the parts, in all layouts."""
    k = F.col("p_partkey") % 6
    n = (F.col("p_size") * 37).cast("string")
    text = (
        F.when(k == 0, F.concat(F.lit("4.5("), n, F.lit(") · Museum"))).when(k == 1, F.concat(F.lit("4,1("), n, F.lit(") · €10–20 · Cafe"))).when(k == 2, F.lit("Ft 20.000+")).when(k == 3, F.lit("47.4979, 19.0402"))
        .when(k == 4, F.concat(F.col("p_name"), F.lit(" street 5"))).otherwise("")
    )
    return P.parse_details(read(spark, d, "part").select("p_partkey", text.alias("Details"))).drop("Details").withColumn("rating", F.col("rating").cast("double"))
