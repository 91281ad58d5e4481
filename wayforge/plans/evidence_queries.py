"""Queries on evidence, audits, publication and privacy."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wayforge.operators import audits, evidence, inventory, publish
from wayforge.operators.textjobs import issues
from wayforge.plans.listing_queries import SCORE_SQL, scored
from wayforge.plans.price_queries import changed
from wayforge.plans.registry import query, read
from wayforge.plans.views import LISTING
from wayforge.session import work_path
from wayforge.sources import pages as P
from wayforge.streaming import picks

WORDS = "CAST(CAST('0x' || substr(sha256(CAST(p_partkey AS VARCHAR)), {i}, 8) AS BIGINT) AS DECIMAL(38,0))"


@query("""WITH w AS (SELECT p_type, count(*) AS n, """ + ", ".join(f"sum({WORDS.format(i=8 * i + 1)}) AS w{i}" for i in range(4)) + """ FROM part GROUP BY 1) SELECT p_type, n, sha256(concat_ws(':', n, w0, w1, w2, w3)) AS digest FROM w""")
def fingerprint(spark, d):
    """O-A11."""
    return publish.fingerprint(read(spark, d, "part"), ["p_type"], F.col("p_partkey"))


@query("""WITH w AS (SELECT p_type, count(*) AS n, """ + ", ".join(f"sum({WORDS.format(i=8 * i + 1)}) AS w{i}" for i in range(4)) + """ FROM (SELECT p_type, CASE WHEN p_size % 4 = 1 THEN -p_partkey ELSE p_partkey END AS p_partkey FROM part WHERE p_size % 4 <> 3) GROUP BY 1) SELECT p_type, n, sha256(concat_ws(':', n, w0, w1, w2, w3)) AS digest FROM w""")
def fingerprint_changes(spark, d):
    """O-A11 as the state of a stream: parts come, some go, and some come under another name, in three batches."""
    part = read(spark, d, "part").select("p_type", F.col("p_partkey").alias("ref"), "p_size")
    changes = part.select("p_type", "ref", F.lit(1).alias("sign"), F.lit(1).alias("at"))
    changes = changes.union(part.where("p_size % 4 in (1, 3)").select("p_type", "ref", F.lit(-1), F.lit(2))).union(part.where("p_size % 4 = 1").select("p_type", -F.col("ref"), F.lit(1), F.lit(3)))
    parts = [changes.where(f"at = {i}").drop("at") for i in (1, 2, 3)]
    plan = lambda stream: publish.fingerprint(stream, ["p_type"], F.col("ref"), F.col("sign"))
    return picks.newest(picks.drain_arrivals(parts, plan, "update", "digests"), ["p_type"]).where("n > 0")


@query("SELECT doc_id, quality, 'second' AS revision FROM labels JOIN documents USING (doc_id) WHERE doc_id % 3 <> 1")
def publication_current(spark, d):
    """O-S10: two revisions are published and a third is refused; readers get both tables of the second."""
    docs, labels = read(spark, d, "documents").select("doc_id"), read(spark, d, "labels").select("doc_id", "quality")
    root, none = work_path(spark, "publication"), docs.limit(0)
    for revision, rows, errors in (("first", "doc_id % 3 = 0", none), ("second", "doc_id % 3 <> 1", none), ("third", "true", docs)):
        tables = {"documents": docs.where(rows), "labels": labels.where(rows)}
        publish.publish(tables, publish.gate(tables["labels"], tables, errors, "doc_id"), root, revision)
    _, tables = publish.published(spark, root)
    return tables["labels"].join(tables["documents"], ["doc_id", "revision"]).select("doc_id", "quality", "revision")


@query("""WITH w AS (SELECT p_type, count(*) AS n, """ + ", ".join(f"sum({WORDS.format(i=8 * i + 1)}) AS w{i}" for i in range(4)) + """ FROM part GROUP BY 1), f AS (SELECT p_type, sha256(concat_ws(':', n, w0, w1, w2, w3)) AS digest FROM w)
    SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'never' WHEN p_size % 3 = 0 THEN 'again' ELSE 'reviewed' END AS state FROM part JOIN f USING (p_type)""")
def stale_review(spark, d):
    """O-ST6: reviews arrive in three batches and are held against the fingerprints of the inventory."""
    part = read(spark, d, "part")
    now = publish.fingerprint(part, ["p_type"], F.col("p_partkey"))
    seen = F.when(F.col("p_size") % 2 == 0, None).when(F.col("p_size") % 3 == 0, F.lit("old")).otherwise(F.col("digest"))
    reviews = part.join(now, "p_type").select("p_partkey", "p_type", seen.alias("seen"))
    out = picks.drain_arrivals(picks.arrivals(reviews, "p_partkey"), lambda stream: picks.review_states(stream, now, "p_type"), "append", "reviews")
    return out.select("p_partkey", "state")


@query("SELECT sha256(text) AS place, count(DISTINCT source) AS sources, count(DISTINCT source) >= 2 AS badge FROM documents GROUP BY 1")
def corroboration(spark, d):
    """O-A12."""
    return inventory.corroborated(read(spark, d, "documents"), F.sha2("text", 256), "source")


@query("SELECT sha256(text) AS id, min(doc_id) AS first_owner, arg_min(doc_id, doc_id) FILTER (k = 2) AS second_owner, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, d):
    """O-A13: ids with several owners, and the first two of them."""
    return inventory.duplicate_ids(read(spark, d, "documents"), F.sha2("text", 256), "doc_id")


ITEM_SQL = """'{"lang":"' || lang || '","n":' || n_chars || ',"text":"' || md5(text) || '"}'"""


@query(f"""SELECT d.doc_id, sha256('{{"item":' || {ITEM_SQL} || ',"version":2}}') AS hash, sha256('{{"item":{{"curated":' || coalesce('{{"quality":' || quality || '}}', 'null') || ',"item":' || {ITEM_SQL} || ',"pricing":"' || n_chars % 7 || '"}},"version":2}}') AS published
    FROM documents d LEFT JOIN labels l USING (doc_id) WHERE lang IS NOT NULL""")
def evidence_hash(spark, d):
    """O-X17: the hash of what is read, and that of all that is published."""
    docs = read(spark, d, "documents").where("lang is not null").join(read(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    item = {"text": F.md5("text"), "lang": F.col("lang"), "n": F.col("n_chars")}
    curated = F.when(F.col("quality").isNotNull(), F.struct("quality"))
    published = evidence.publication_hash(2, item=F.struct(*(item[k].alias(k) for k in sorted(item))), pricing=(F.col("n_chars") % 7).cast("string"), curated=curated)
    return docs.select("doc_id", publish.canonical_hash(2, **item).alias("hash"), published.alias("published"))


@query("""SELECT doc_id, code FROM (SELECT doc_id, 'stale' AS code FROM labels WHERE doc_id % 9 = 0 UNION ALL SELECT doc_id, 'revision' FROM labels WHERE doc_id % 50 = 1 UNION ALL SELECT doc_id, 'no-evidence' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 40 <> 2)) WHERE NOT (code = 'stale' AND doc_id % 40 = 2)""")
def published_verify(spark, d):
    """O-Q14: record hashes against the evidence's, one revision for all, which is recomputed."""
    docs = read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    records = read(spark, d, "labels").join(docs, "doc_id").select("doc_id", F.when(F.col("doc_id") % 9 == 0, "old").otherwise(F.col("hash")).alias("hash"))
    stamped = records.join(F.broadcast(publish.revision(records, "doc_id").select("digest")))  # one row
    stamped = stamped.select("doc_id", "hash", F.when(F.col("doc_id") % 50 == 1, "r1").otherwise(F.col("digest")).alias("revision"))
    return publish.verify(stamped, docs.where("doc_id % 40 <> 2"), "doc_id")


@query("""SELECT m = 0 AND e = 0 AS ok, m AS missing, e AS errors FROM (SELECT count(*) FILTER (l.doc_id IS NULL OR d.doc_id % 7 = 3) AS m, count(*) FILTER (l.toxic = 1) AS e FROM documents d LEFT JOIN labels l USING (doc_id))""")
def publication_gate(spark, d):
    """O-S10: documents need a label and a brief, and no current error."""
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    return publish.gate(docs, {"labels": labels, "briefs": docs.where("doc_id % 7 <> 3")}, labels.where("toxic = 1"), "doc_id")


SENTINELS = [(3, "ECONOMY"), (10, "PROMO"), (20, "LARGE"), (10_000_000, "SMALL")]


@query("""SELECT key, CASE WHEN p_partkey IS NULL THEN 'missing' WHEN p_type <> label THEN 'mismatch' ELSE 'ok' END AS state FROM (VALUES (3, 'ECONOMY'), (10, 'PROMO'), (20, 'LARGE'), (10000000, 'SMALL')) AS s(key, label) LEFT JOIN part ON p_partkey = key""")
def sentinel_check(spark, d):
    """O-Q12."""
    pinned = spark.createDataFrame(SENTINELS, "key long, label string")
    return inventory.sentinels(read(spark, d, "part").select(F.col("p_partkey").alias("key"), F.col("p_type").alias("label")), pinned, "key", "label")


@query("""SELECT l_orderkey, l_linenumber, 'metadata' AS code, field FROM (SELECT l.*, unnest(['quantity', 'price', 'flag', 'priority', 'status', 'total', 'customer', 'date', 'supplier', 'part']) AS field FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey) JOIN orders ON l_orderkey = o_orderkey
    WHERE (field = 'quantity' AND l_quantity > 49) OR (field = 'price' AND l_extendedprice <> round(l_extendedprice, 1)) OR (field = 'flag' AND l_returnflag = 'R') OR (field = 'status' AND l_linestatus <> o_orderstatus)""")
def metadata_agreement(spark, d):
    """O-Q1: ten fields of lines against what another view of the same lines says."""
    o = read(spark, d, "orders")
    # both views lie by l_orderkey, so lines are shuffled once; an order has a few
    rows = read(spark, d, "lineitem").join(o.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    key = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    a = rows.select("l_orderkey", key.alias("line"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("flag"), F.col("o_orderpriority").alias("priority"), F.col("l_linestatus").alias("status"), F.col("o_totalprice").alias("total"), F.col("o_custkey").alias("customer"), F.col("o_orderdate").alias("date"), F.col("l_suppkey").alias("supplier"), F.col("l_partkey").alias("part"))
    b = rows.select("l_orderkey", key.alias("line"), F.least("l_quantity", F.lit(49)).cast(a.schema["quantity"].dataType).alias("quantity"), F.round("l_extendedprice", 1).alias("price"), F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("flag"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"), F.col("o_custkey").alias("customer"), F.col("o_orderdate").alias("date"), F.col("l_suppkey").alias("supplier"), F.col("l_partkey").alias("part"))
    out = publish.disagreements(a, b.distinct(), "line", ["quantity", "price", "flag", "priority", "status", "total", "customer", "date", "supplier", "part"], group="l_orderkey")
    return out.select("l_orderkey", "line.l_linenumber", "code", "field")


@query("""WITH e AS (SELECT doc_id FROM documents WHERE doc_id % 10 <> 0), i AS (SELECT CASE WHEN length(text) > 4000 THEN 'too-long' ELSE 'short' END AS code FROM documents WHERE length(text) > 4000 OR length(text) < 100),
    m AS (SELECT (SELECT count(*) FROM e) AS e, (SELECT count(*) FROM labels) AS p, (SELECT count(*) FROM labels WHERE doc_id IN (SELECT * FROM e)) AS a, (SELECT count(*) FROM e WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS m, (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT * FROM e)) AS u, (SELECT count(*) FROM i) AS i)
    SELECT 'count' AS part, unnest(['expected', 'present', 'audited', 'missing', 'unexpected', 'issues']) AS name, unnest([e, p, a, m, u, i]) AS n FROM m UNION ALL SELECT 'code', code, count(*) FROM i GROUP BY 2 UNION ALL SELECT 'source', CAST(quality AS VARCHAR), count(*) FROM labels GROUP BY 2 UNION ALL SELECT 'ok', 'ok', CASE WHEN m + u + i = 0 THEN 1 ELSE 0 END FROM m""")
def issue_report(spark, d):
    """O-A16."""
    docs = read(spark, d, "documents")
    found = issues(docs, "doc_id", {"too-long": F.length("text") > 4000, "short": F.length("text") < 100})
    return publish.report(found, docs.where("doc_id % 10 <> 0"), read(spark, d, "labels"), "doc_id", "quality")


@query("""WITH r AS (SELECT user_id AS member, event_id AS key, CASE WHEN event_type IN ('click', 'view') THEN 'activity' ELSE 'category' END AS kind, CAST(floor(value) AS BIGINT) % 6 AS rating, CASE WHEN event_id % 3 = 0 THEN 'n' || event_id ELSE '' END AS note, event_type = 'error' AS reviewed FROM events),
    k AS (SELECT *, row_number() OVER (PARTITION BY member, kind ORDER BY key) AS pos, '{"key":' || key || ',"rating":' || rating || ',"note":"' || note || '","reviewed":' || reviewed || '}' AS item FROM r WHERE kind <> 'category' OR reviewed OR note <> ''), m AS (SELECT DISTINCT member FROM k)
    SELECT member, CASE kind WHEN 'activity' THEN 1 ELSE 3 END AS section, pos AS line, CASE WHEN pos > 1 THEN ',' ELSE '' END || item AS text FROM k UNION ALL SELECT member, 0, 0, '{"schemaVersion":3,"activities":[' FROM m UNION ALL SELECT member, 2, 0, '],"categories":[' FROM m UNION ALL SELECT member, 4, 0, ']}' FROM m""")
def export_document(spark, d):
    """O-S12: the lines of a document for each member."""
    kind = F.when(F.col("event_type").isin("click", "view"), "activity").otherwise("category")
    note = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("n"), F.col("event_id").cast("string"))).otherwise("")
    rows = read(spark, d, "events").select(F.col("user_id").alias("member"), F.col("event_id").alias("key"), kind.alias("kind"), (F.floor("value").cast("bigint") % 6).alias("rating"), note.alias("note"), (F.col("event_type") == "error").alias("reviewed"))
    return publish.export(rows)


#: Names of personal fields, without underscores and in small letters.
DENIED = "author authorid authorname avatar avatarurl displayname firstname lastname managementresponseauthor memberid memberprofile photo photos profileid profileurl responseauthor userid username userprofile".split()


def nested(spark, d):
    k = F.get_json_object("props", "$.k")
    user = F.struct(F.col("user_id").cast("string").alias("user_id"), F.lit("x").alias("kind"))
    link = F.concat(F.lit("/Page-g1-d"), (F.col("event_id") % 7).cast("string"), F.lit("-x.html"))
    first = F.struct(F.when(F.col("event_id") % 2 == 0, F.lit("a@b")).alias("display_name"), user.alias("writer"), link.alias("url"))
    doc = F.struct(F.col("event_id").alias("locationId"), F.struct(k.alias("k"), F.array(first).alias("reviews")).alias("data"))
    return read(spark, d, "events").select("event_id", "user_id", F.to_json(doc).alias("doc"))


@query("""SELECT event_id, '$.data.reviews[0].writer.user_id' AS path FROM events UNION ALL SELECT event_id, '$.data.reviews[0].display_name' FROM events WHERE event_id % 2 = 0""")
def privacy_scan(spark, d):
    """O-X14: events wrapped in nested JSON; every denied key at any depth."""
    return publish.nested_keys(nested(spark, d), "event_id", "doc", DENIED)


@query("""SELECT event_id, '{"locationId":' || event_id || ',"data":{"k":"' || json_extract_string(props, '$.k') || '","reviews":[{"writer":{"kind":"x"}}]}}' AS doc FROM events""")
def strip_fields(spark, d):
    """O-X15: an allow-list schema drops everything else."""
    allow = "locationId long, data struct<k: string, reviews: array<struct<writer: struct<kind: string>>>>"
    return publish.allow_listed(nested(spark, d), "event_id", "doc", allow)


@query("""SELECT event_id, array_to_string(list_sort(list_distinct([CAST(event_id AS VARCHAR), CAST(event_id % 7 AS VARCHAR)])), ',') AS ids FROM events""")
def nested_ids(spark, d):
    """O-X16: all ids in a document, wherever they stand, and those in links."""
    return nested(spark, d).select("event_id", F.array_join(evidence.nested_identities(F.col("doc")), ",").alias("ids"))


CONTRACT = [("user", "q-user", "{}", 3, True), ("assistant", "q-assistant", None, 3, True), ("system", "q-system", None, 1, False)]


@query("""WITH a AS (SELECT conv_id, role AS query, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn, turn, role = 'assistant' AND conv_id % 5 = 0 AS settles FROM conversations), b AS (SELECT *, max(settles) OVER (PARTITION BY conv_id, query ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS done FROM a)
    SELECT conv_id, query, code FROM (SELECT conv_id, query, 'graphql-attempt-order' AS code FROM b WHERE turn % 5 = 4 UNION ALL SELECT conv_id, query, 'graphql-query-id' FROM b WHERE conv_id % 13 = 0 UNION ALL SELECT conv_id, query, 'graphql-http' FROM b WHERE conv_id % 17 = 0 UNION ALL SELECT conv_id, query, 'graphql-variables' FROM b WHERE (conv_id % 11 = 0 AND query = 'user') OR conv_id % 19 = 0
        UNION ALL SELECT conv_id, query, 'graphql-response' FROM b WHERE conv_id % 23 = 0 UNION ALL SELECT conv_id, query, 'graphql-polls' FROM b WHERE rn = CASE query WHEN 'system' THEN 2 ELSE 4 END UNION ALL SELECT conv_id, query, 'graphql-after-settle' FROM b WHERE done) WHERE query IN ('user', 'assistant', 'system') AND NOT (conv_id % 7 = 3 AND query = 'system')
    UNION ALL SELECT conv_id, 'tool', 'graphql-query-unexpected' FROM b WHERE conv_id % 7 = 3 AND query = 'system' AND rn = 1
    UNION ALL SELECT conv_id, 'tool', unnest(list_concat(CASE WHEN turn % 5 = 4 THEN ['graphql-attempt-order'] ELSE [] END, CASE WHEN conv_id % 17 = 0 THEN ['graphql-http'] ELSE [] END, CASE WHEN conv_id % 19 = 0 THEN ['graphql-variables'] ELSE [] END, CASE WHEN conv_id % 23 = 0 THEN ['graphql-response'] ELSE [] END)) FROM b WHERE conv_id % 7 = 3 AND query = 'system'
    UNION ALL SELECT conv_id, q, 'graphql-query-missing' FROM (SELECT DISTINCT conv_id FROM conversations) c, (VALUES ('user'), ('assistant')) AS v(q) WHERE NOT EXISTS (SELECT 1 FROM conversations x WHERE x.conv_id = c.conv_id AND x.role = q)""")
def request_log_contract(spark, d):
    """O-Q9: logs of queries against a contract table; every kind of fault occurs."""
    contract = spark.createDataFrame(CONTRACT, "query string, query_id string, variables string, most int, required boolean")
    c, turn = F.col("conv_id"), F.col("turn")
    own = F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn"))
    name = F.when((c % 7 == 3) & (F.col("role") == "system"), "tool").otherwise(F.col("role"))
    attempts = read(spark, d, "conversations").select(
        "conv_id", name.alias("query"), turn.alias("at"), (own + F.when(turn % 5 == 4, 1).otherwise(0)).alias("ordinal"), F.concat(F.lit("q-"), F.when(c % 13 == 0, "old").otherwise(F.col("role"))).alias("query_id"), F.when(c % 17 == 0, 500).otherwise(200).alias("http"),
        F.when(c % 19 == 0, None).when(c % 11 == 0, '{"a":1}').otherwise("{}").alias("variables"), F.when((F.col("role") == "assistant") & (c % 5 == 0), "SUCCESS").otherwise("PENDING").alias("status"), (c % 23 != 0).alias("has_data"),
    )
    return audits.request_log_issues(attempts, contract, "conv_id")


@query(f"""WITH {LISTING} SELECT l.key, name, {SCORE_SQL} AS score, city || '-' || category AS place, CASE WHEN key % 3 = 0 THEN '' ELSE 'img/' || key || '.jpg' END AS img, CASE WHEN category <> 'PROMO' THEN category || ',PROMO' ELSE category END AS cats FROM listing l WHERE key % 4 <> 0""")
def inventory_projection(spark, d):
    """O-P5: new rows only, the first photo or none, primary and other categories once each in order."""
    k = F.col("key")
    photos = F.when(k % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("img/"), k.cast("string"), F.lit(".jpg")), F.lit("other")))
    rows = scored(spark, d).withColumns({"status": F.when(k % 4 == 0, "dup").otherwise("new"), "photos": photos, "others": F.array(F.lit("PROMO"), F.col("category"))})
    out = inventory.projected(rows, "photos", "category", "others")
    return out.select("key", "name", "score", F.concat_ws("-", "city", "category").alias("place"), "img", F.array_join("cats", ",").alias("cats"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'img-' || doc_id ELSE md5(trim(regexp_replace(lower(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-')) END AS slug FROM documents""")
def slug_key(spark, d):
    """O-P6: the first image's slug, else one of the whole text without accents, as its digest."""
    image = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("img-"), F.col("doc_id").cast("string")))
    out = inventory.slug_keys(read(spark, d, "documents"), "text", image)
    return out.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("slug")).otherwise(F.md5("slug")).alias("slug"))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, CASE WHEN l_linenumber = 1 THEN 'A' || l_orderkey || ':' || l_suppkey ELSE 'pkg-' || substr(sha256(concat_ws('|', l_linenumber, l_orderkey, l_suppkey)), 1, 16) END AS id FROM lineitem""")
def package_id(spark, d):
    """O-X22: a supplied id of the right form, else the start of a hash."""
    given = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("A"), F.col("l_orderkey").cast("string"), F.lit(":"), F.col("l_suppkey").cast("string"))).otherwise("bad id!")
    made = evidence.package_id(given, F.col("l_linenumber"), F.col("l_orderkey"), F.col("l_suppkey"))
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", made.alias("id"))


@query("""SELECT doc_id, CASE WHEN lower(split_part(text, ' ', 1)) = 'the' AND doc_id % 2 = 0 THEN 'Page ' || doc_id ELSE trim(split_part(text, ' ', 1)) END AS name, quality FROM documents LEFT JOIN labels USING (doc_id)""")
def context_assembly(spark, d):
    """O-P9: a name that is only an article gives way to the page's title of several words."""
    docs = read(spark, d, "documents")
    title = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("“Page” "), F.col("doc_id").cast("string"))).otherwise("Page")
    details = docs.select("doc_id", title.alias("page_title")).join(read(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return evidence.contexts(docs.select("doc_id", F.substring_index("text", " ", 1).alias("name")), details, "doc_id").select("doc_id", "name", "quality")


@query("""SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END, o_orderpriority) AS name, CAST(n AS INTEGER) AS n_reviews, 'Costs [price listed separately] for line ' || CAST(low AS VARCHAR) || '.' AS first_review, md5('About [price listed separately] a day. Fine.') AS description,
    CASE WHEN o_orderkey % 2 = 0 THEN 'P' || o_orderkey ELSE 'pkg-' || substr(sha256(concat_ws('|', 0, 'Tour', '', 'at 9')), 1, 16) END AS package FROM orders JOIN (SELECT l_orderkey, least(count(*), 10) AS n, min(l_linenumber) AS low FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def evidence_prepare(spark, d):
    """O-P10: inventory fields first, context as fallback, reviews without money, bodies out of titles, packages with ids."""
    k = F.col("o_orderkey")
    review = F.struct("l_linenumber", F.concat(F.lit("Costs €5 for line "), F.col("l_linenumber").cast("string"), F.lit(".")).alias("text"))
    reviews = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(review)).alias("r"))  # an order has a few lines
    reviews = reviews.select(F.col("l_orderkey").alias("o_orderkey"), F.transform("r", lambda x: F.struct(F.lit("").alias("title"), x["text"].alias("text"), F.lit(5).alias("rating"))).alias("reviews"))
    none = lambda t: F.lit(None).cast(t)
    o = read(spark, d, "orders")
    fields = {"category": none("string"), "subtype": none("string"), "rating": none("double"), "review_count": none("long"), "url": none("string")}
    rows = o.select("o_orderkey", F.when(k % 5 != 0, F.col("o_orderstatus")).alias("name"), *(c.alias(n) for n, c in fields.items()))
    package = F.array(F.struct(F.when(k % 2 == 0, F.concat(F.lit("P"), k.cast("string"))).otherwise("bad id!").alias("id"), F.lit("Tour").alias("name"), F.lit("").alias("description"), F.lit("at 9").alias("times")))
    context = o.select("o_orderkey", F.col("o_orderpriority").alias("name"), *(c.alias(n) for n, c in fields.items()), F.lit("About 20 EUR a day. Fine.").alias("description"), F.lit("2024-05-01").alias("checked_at"), package.alias("packages")).join(reviews, "o_orderkey")
    out = evidence.prepared(rows, context, "o_orderkey")
    return out.select("o_orderkey", "name", F.size("reviews").alias("n_reviews"), F.col("reviews")[0]["text"].alias("first_review"), F.md5("description").alias("description"), F.col("packages")[0]["id"].alias("package"))


@query("""SELECT doc_id, CASE WHEN quality = 1 THEN 'activity page + sampled reviews' ELSE 'activity page' END AS source_label, CASE WHEN quality = 1 THEN 1 END AS reviews_used, CASE WHEN quality = 1 THEN 'sum ' || doc_id END AS review_summary, CASE WHEN doc_id % 2 = 0 THEN 'c' ELSE 'u' END || doc_id AS source, CASE WHEN quality = 1 THEN CASE WHEN doc_id % 2 = 0 THEN 'c' ELSE 'u' END || doc_id END AS review_source FROM documents LEFT JOIN labels USING (doc_id)""")
def brief_assembly(spark, d):
    """O-P11: review fields only where reviews were used."""
    k = F.col("doc_id").cast("string")
    docs = read(spark, d, "documents").select("doc_id").join(read(spark, d, "labels"), "doc_id", "left")
    outputs = docs.select("doc_id", F.lit("what").alias("what"), F.lit("do").alias("do"), F.lit("why").alias("why"), F.lit("grounded").alias("research"), F.col("quality").cast("int").alias("reviews_used"), F.concat(F.lit("sum "), k).alias("review_summary"))
    pages = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("c"), k)).alias("canonical_url"), F.concat(F.lit("u"), k).alias("url"), F.lit("2024-05-01").alias("checked_at"))
    return evidence.briefs(outputs, pages, "doc_id").select("doc_id", "source_label", "reviews_used", "review_summary", "source", "review_source")


@query("""SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) WHEN o_orderkey % 3 = 1 THEN DATE '2024-05-01' ELSE CAST(o_orderdate AS DATE) + 1 END AS VARCHAR) AS checked, CASE o_orderkey % 3 WHEN 0 THEN 'embedded' WHEN 1 THEN 'live' ELSE 'file' END AS provenance FROM orders""")
def check_date(spark, d):
    """O-P12: the embedded date, else the live one, else the file's."""
    k = F.col("o_orderkey") % 3
    day = F.col("o_orderdate").cast("date")
    embedded = F.try_to_date(F.when(k == 0, F.date_format(day, "yyyy-MM-dd")), "yyyy-MM-dd")
    made, how = evidence.checked_on(embedded, k == 1, F.lit("2024-05-01").cast("date"), F.date_add(day, 1).cast("timestamp"))
    return read(spark, d, "orders").select("o_orderkey", made.cast("string").alias("checked"), how.alias("provenance"))


@query("""SELECT p_partkey, code FROM (SELECT p_partkey, 'short-p_name' AS code FROM part WHERE length(trim(p_name)) <= 8 UNION ALL SELECT p_partkey, 'enum-p_type' FROM part WHERE p_type NOT IN ('ECONOMY', 'PROMO', 'SMALL') UNION ALL SELECT p_partkey, 'list-words' FROM part WHERE len(list_distinct(string_split(p_name, ' '))) <> len(string_split(p_name, ' ')) UNION ALL SELECT p_partkey, 'source' FROM part WHERE p_size > 48 UNION ALL SELECT p_partkey, 'duplicate-id' FROM part WHERE p_size = 9)""")
def record_completeness(spark, d):
    """O-Q17."""
    part = read(spark, d, "part").withColumns({"words": F.split("p_name", " "), "sources": F.array(F.lit("https://a"), F.when(F.col("p_size") > 48, "http://b").otherwise("https://b"))})
    part = part.union(part.where("p_size = 9").withColumns({"p_name": F.lit("a proper name"), "p_type": F.lit("PROMO"), "words": F.array(F.lit("a"))}))
    return audits.completeness_issues(part, "p_partkey", ["p_name"], {"p_type": ("ECONOMY", "PROMO", "SMALL")}, ["words"], "sources", least=8)


FLOORS = [("ECONOMY", 100), ("PROMO", 500), ("SMALL", 10), ("GONE", 1)]


@query("""SELECT f.p_type, least_ AS least, count(p_partkey) AS n, count(p_partkey) < least_ AS below FROM (VALUES ('ECONOMY', 100), ('PROMO', 500), ('SMALL', 10), ('GONE', 1)) AS f(p_type, least_) LEFT JOIN part USING (p_type) GROUP BY 1, 2 UNION ALL SELECT '*', 1100, count(*), count(*) < 1100 FROM part""")
def group_floors(spark, d):
    """O-A3: floors of groups and of the whole inventory."""
    floors = spark.createDataFrame(FLOORS, "p_type string, least int")
    return inventory.group_floors(read(spark, d, "part"), floors, "p_type", 1100)


@query("""SELECT quality AS verdict, count(*) AS n, CASE quality WHEN 1 THEN 300 ELSE 50 END AS stated, count(*) <> CASE quality WHEN 1 THEN 300 ELSE 50 END AS mismatch FROM labels GROUP BY 1 UNION ALL SELECT 7, 0, 3, TRUE""")
def qa_tally(spark, d):
    """O-A17: verdicts against stated totals."""
    rows = read(spark, d, "labels").select(F.col("quality").cast("int").alias("verdict"))
    return inventory.verdict_tally(rows, "verdict", {1: 300, 0: 50, 7: 3})


@query("""SELECT event_id, code FROM (SELECT event_id, 'listing-rating' AS code FROM events WHERE value / 50 NOT BETWEEN 0 AND 5 UNION ALL SELECT event_id, 'review-rating' FROM events WHERE floor(value) NOT BETWEEN 1 AND 5 UNION ALL SELECT event_id, 'listing-review-count' FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) - 5 < 0)""")
def domain_checks(spark, d):
    """O-Q2."""
    e = read(spark, d, "events").select("event_id", (F.col("value") / 50).alias("rating"), F.floor("value").cast("double").alias("review"), (F.get_json_object("props", "$.k").cast("int") - 5).alias("reviews"))
    return audits.domain_issues(e, "event_id", "rating", "review", "reviews")


@query(r"""WITH p AS (SELECT page_id, regexp_extract(lower(url), '/([0-9]+)(?:[?#/]|$)', 1) AS id, regexp_matches(lower(url), '^https?://(?:[^/?#:]*\.)?example\.(com|net|org)(?:[/?#:]|$)') AS good FROM pages)
    SELECT page_id, code FROM (SELECT page_id, 'inventory-identity' AS code FROM p WHERE id = '' UNION ALL SELECT page_id, 'stored-identity' FROM p WHERE page_id % 20 = 0 UNION ALL SELECT page_id, 'canonical-identity' FROM p WHERE page_id % 15 = 0 OR page_id % 14 = 0 UNION ALL SELECT page_id, 'canonical-host' FROM p WHERE page_id % 14 = 0 OR (page_id % 15 <> 0 AND NOT good))""")
def identity_checks(spark, d):
    """O-Q3: inventory, stored and canonical address name the same page."""
    url, i = F.col("url"), F.col("page_id")
    p = read(spark, d, "pages").select("page_id", "url", F.when(i % 20 == 0, F.lit("https://example.com/x/0")).otherwise(url).alias("stored"), F.when(i % 14 == 0, None).when(i % 15 == 0, F.lit("https://example.com/x/1")).otherwise(url).alias("canonical"))
    return audits.identity_issues(p, "page_id", "url", "stored", "canonical", P.identity, r"(?:^|\.)example\.(com|net|org)$")


@query("""SELECT doc_id, 'stale-parse' AS code FROM documents WHERE n_chars + CASE WHEN doc_id % 19 = 0 THEN 1 ELSE 0 END <> length(text)""")
def stale_derivation(spark, d):
    """O-Q7: stored derived fields against what today's code derives."""
    docs = read(spark, d, "documents").withColumns({"stored": F.col("n_chars") + F.when(F.col("doc_id") % 19 == 0, 1).otherwise(0), "first": F.substring_index("text", " ", 1)})
    return audits.stale_derivations(docs, "doc_id", {"stored": F.length("text"), "first": F.substring_index("text", " ", 1)})


#: Changes of one thing in a valid publication, and the one code that each gives.
PUBLISHED = {
    1: ("what", "", "brief-what"), 2: ("do", "x" * 321, "brief-do-length"), 3: ("summary", "x" * 241, "brief-summary-length"), 4: ("source", "http://a", "source"), 5: ("checked_at", "May 2024", "checked-at"), 6: ("provenance", "guess", "provenance"), 7: ("status", "open", "price-status"),
    8: ("starting", "05.123", "starting-price"), 9: ("kind", "gift", "package-kind"), 10: ("amount", "1,5", "package-amount"), 11: ("status", "unavailable", "status-packages"), 12: ("status", "free", "status-free"), 13: ("status", "not-published", "status-not-published"),
}


@query(f"SELECT o_orderkey, code FROM orders JOIN (VALUES {', '.join(f"({k}, '{c}')" for k, (_, _, c) in PUBLISHED.items())}) AS v(k, code) ON o_orderkey % 16 = k")
def publication_schema(spark, d):
    """O-Q11: one change in a valid record or package, one code."""
    valid = {"what": "A walk.", "do": "Walk.", "why": "Nice.", "summary": "Liked.", "source": "https://a", "checked_at": "2024-05-01", "provenance": "generated", "status": "priced", "starting": "12.50", "currency": "EUR"}
    package = {"kind": "exact", "amount": "15", "availability": "available"}
    k = F.col("o_orderkey") % 16
    faults = {i: (c, v) for i, (c, v, _) in PUBLISHED.items()}
    rows = read(spark, d, "orders").select("o_orderkey")
    records = rows.select("o_orderkey", *changed(valid, faults, k)).withColumn("starting", F.when(F.col("status") == "priced", F.col("starting")))
    packs = rows.select("o_orderkey", *changed(package, faults, k)).where(k != 0)
    return audits.publication_issues(records, packs, "o_orderkey")


@query(r"""SELECT p_name || p_partkey AS key, code FROM part, (VALUES ('reserved'), ('unsafe-id'), ('raw-description')) AS v(code) WHERE (code = 'reserved' AND starts_with(p_name, 'red')) OR (code = 'unsafe-id' AND (NOT regexp_matches(CASE p_size WHEN 1 THEN '__proto__' WHEN 2 THEN 'a b' ELSE p_brand END, '^[A-Za-z0-9][A-Za-z0-9._:#-]*$'))) OR (code = 'raw-description' AND p_size = 13)""")
def namespace_checks(spark, d):
    """O-Q13: reserved prefixes, unsafe ids, and text that must not ship."""
    id_ = F.when(F.col("p_size") == 1, "__proto__").when(F.col("p_size") == 2, "a b").otherwise(F.col("p_brand"))
    rows = read(spark, d, "part").select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("key"), id_.alias("id"), F.when(F.col("p_size") == 13, F.lit("raw")).alias("description"))
    return audits.namespace_issues(rows, "key", "red", "id", ["description"])


@query("""SELECT CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS key, CASE WHEN p_partkey % 10 = 0 THEN 'no-key' WHEN p_partkey % 10 = 7 THEN 'duplicate-key' WHEN p_partkey % 10 = 1 THEN 'schema' ELSE 'ok' END AS code FROM part""")
def strict_json(spark, d):
    """O-S4: parts written as JSON, some without a key, some twice, some of a wrong type, and read back strictly."""
    k = F.col("p_partkey")
    part = read(spark, d, "part")
    size = F.when(k % 10 == 1, F.lit("many")).otherwise(F.col("p_size").cast("string"))
    key = F.when(k % 10 != 0, F.concat(F.lit('"'), k.cast("string"), F.lit('"'))).otherwise("null")
    line = F.concat(F.lit('{"key":'), key, F.lit(',"size":'), F.when(k % 10 == 1, F.concat(F.lit('"'), size, F.lit('"'))).otherwise(size), F.lit("}"))
    path = work_path(spark, "strict-json")
    part.select(line.alias("value")).union(part.where("p_partkey % 10 = 7").select(line.alias("value"))).write.text(path)
    good, bad = P.strict_json(spark, path, "key string, size int", "key", one_list=False)
    return good.select("key", F.lit("ok").alias("code")).unionByName(bad)
