"""Queries on duplicates, aliases, work sets, upserts and quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayforge.functions.text import match_name
from wayforge.operators import inventory, matching, pricing, worksets
from wayforge.plans.registry import query, read

NORM_SQL = r"trim(regexp_replace(regexp_replace(regexp_replace(replace(lower(strip_accents({x})), '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), '\b(the|a|an|in|of|red)\b', ' ', 'g'), ' +', ' ', 'g'))"


def names(spark, d):
    return read(spark, d, "part").select(F.col("p_partkey").alias("id"), match_name(F.col("p_name"), places=("red",)).alias("norm"), F.when(F.col("p_size") % 2 == 0, "venue").otherwise("experience").alias("kind"), "p_name")


@query(f"""WITH n AS (SELECT p_partkey AS id, {NORM_SQL.format(x='p_name')} AS norm, p_name FROM part),
    e AS (SELECT norm, min_by(p_name, id) AS matched FROM n WHERE id % 3 = 0 GROUP BY 1)
    SELECT id, norm, matched, CASE WHEN matched IS NULL THEN 'new' ELSE 'dup' END AS status FROM n LEFT JOIN e USING (norm) WHERE id % 3 <> 0""")
def exact_name_dup(spark, d):
    """O-X2, O-J1: a third of the parts is the existing inventory, the others are new."""
    n = names(spark, d)
    existing = n.where("id % 3 = 0").select(F.col("p_name").alias("orig"), "norm", F.col("id").alias("ordinal"))
    return matching.exact_match(n.where("id % 3 <> 0").select("id", "norm"), existing).select("id", "norm", "matched", "status")


@query("""WITH new AS (SELECT c_custkey AS id, trim(lower(c_mktsegment) || ' nation ' || c_nationkey || ' tour ' || CASE WHEN c_custkey % 3 = 0 THEN 'deluxe' ELSE '' END) AS norm, CASE WHEN c_custkey % 2 = 0 THEN 'venue' ELSE 'experience' END AS kind FROM customer),
    existing AS (SELECT s_suppkey AS ordinal, s_name AS orig, trim(CASE s_suppkey % 4 WHEN 0 THEN 'building' WHEN 1 THEN 'machinery' WHEN 2 THEN 'nation' ELSE 'hold' END || ' nation ' || s_nationkey || CASE WHEN s_suppkey % 5 = 0 THEN ' tour' ELSE '' END) AS norm,
        CASE WHEN s_suppkey % 3 = 0 THEN 'venue' ELSE 'experience' END AS kind, s_suppkey % 11 = 0 AS is_generic FROM supplier)
    SELECT id, min_by(orig, ordinal) AS orig, min(ordinal) AS ordinal FROM new n JOIN existing e ON n.norm = e.norm
        OR (NOT e.is_generic AND n.kind = e.kind AND ((contains(n.norm, e.norm) AND length(e.norm) >= 13 AND len(string_split(e.norm, ' ')) >= 2) OR (contains(e.norm, n.norm) AND length(n.norm) >= 13 AND len(string_split(n.norm, ' ')) >= 2)))
    GROUP BY id""")
def guarded_containment(spark, d):
    """O-J2: names that hold one another, met on a shared word rather than compared all with all."""
    segment, nation, deluxe = F.lower("c_mktsegment"), F.col("c_nationkey").cast("string"), F.when(F.col("c_custkey") % 3 == 0, "deluxe").otherwise("")
    kind = lambda c, n: F.when(F.col(c) % n == 0, "venue").otherwise("experience")
    new = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.trim(F.concat_ws(" ", segment, F.lit("nation"), nation, F.lit("tour"), deluxe)).alias("norm"), kind("c_custkey", 2).alias("kind"))
    first = F.when(F.col("s_suppkey") % 4 == 0, "building").when(F.col("s_suppkey") % 4 == 1, "machinery").when(F.col("s_suppkey") % 4 == 2, "nation").otherwise("hold")
    norm = F.concat(first, F.lit(" nation "), F.col("s_nationkey").cast("string"), F.when(F.col("s_suppkey") % 5 == 0, " tour").otherwise(""))
    existing = read(spark, d, "supplier").select(F.col("s_suppkey").alias("ordinal"), F.col("s_name").alias("orig"), norm.alias("norm"), kind("s_suppkey", 3).alias("kind"), (F.col("s_suppkey") % 11 == 0).alias("is_generic"))
    return matching.guarded_containment(new, existing)


SNAPSHOTS = """old AS (SELECT p_brand AS city, p_name AS name, p_partkey AS id FROM part WHERE p_partkey % 3 <> 2),
    new AS (SELECT p_brand AS city, p_name AS name, CASE WHEN p_partkey % 5 = 0 THEN p_partkey + 1000000 ELSE p_partkey END AS id FROM part WHERE p_partkey % 7 <> 3)"""


def snapshots(spark, d):
    part = read(spark, d, "part").select(F.col("p_brand").alias("city"), F.col("p_name").alias("name"), F.col("p_partkey").alias("id"))
    new = part.where("id % 7 <> 3").withColumn("id", F.when(F.col("id") % 5 == 0, F.col("id") + 1000000).otherwise(F.col("id")))
    return part.where("id % 3 <> 2"), new


def owner_sql(name: str) -> str:
    """CTEs of the owners of the keys of one snapshot (city, name, id) in the target ``new``."""
    return f"""{name}_step AS (SELECT o.city, o.name, o.id, s.single, m.city IS NOT NULL AS many, n.id IS NOT NULL AS same FROM {name} o LEFT JOIN singles s USING (city, name) LEFT JOIN many m USING (city, name) LEFT JOIN new n ON n.city = o.city AND n.name = o.name AND n.id = o.id),
    {name}_lft AS (SELECT *, row_number() OVER (PARTITION BY city, name ORDER BY id) AS rn, count(*) OVER (PARTITION BY city, name) AS n FROM {name}_step WHERE many AND NOT same),
    {name}_free AS (SELECT city, name, id, row_number() OVER (PARTITION BY city, name ORDER BY id) AS rn, count(*) OVER (PARTITION BY city, name) AS m FROM new JOIN many USING (city, name) WHERE NOT EXISTS (SELECT 1 FROM {name}_step t WHERE many AND same AND t.city = new.city AND t.name = new.name AND t.id = new.id)),
    {name}_own AS (SELECT t.city, t.name, t.id, coalesce(t.single, CASE WHEN t.many AND t.same THEN t.id END, f.id, t.id) AS owner, CASE WHEN t.single IS NOT NULL THEN 'name' WHEN t.many AND t.same THEN 'identity' WHEN f.id IS NOT NULL THEN 'order' ELSE 'self' END AS how
        FROM {name}_step t LEFT JOIN {name}_lft l USING (city, name, id) LEFT JOIN {name}_free f ON f.city = l.city AND f.name = l.name AND f.rn = l.rn AND f.m = l.n)"""


@query(f"""WITH older AS (SELECT p_brand AS city, p_name AS name, p_partkey AS id FROM part WHERE p_partkey % 4 <> 1), {SNAPSHOTS}, singles AS (SELECT city, name, min(id) AS single FROM new GROUP BY 1, 2 HAVING count(*) = 1), many AS (SELECT city, name FROM new GROUP BY 1, 2 HAVING count(*) > 1),
    {owner_sql('older')}, {owner_sql('old')},
    keys AS (SELECT 1 AS snap, o.*, row_number() OVER (PARTITION BY city, name ORDER BY id) AS k FROM older_own o UNION ALL SELECT 2, o.*, row_number() OVER (PARTITION BY city, name ORDER BY id) FROM old_own o),
    claims AS (SELECT city || '|' || name || CASE WHEN k = 1 THEN '' ELSE '#' || id END AS alias, city, owner, how, snap, id FROM keys UNION ALL SELECT 'extra ' || id, city, owner, how, snap, id FROM keys WHERE id % 10 = 0),
    firsts AS (SELECT alias, arg_min(owner, (snap, id)) AS owner, arg_min(how, (snap, id)) AS how, min(snap) AS snapshot FROM claims GROUP BY 1)
    SELECT alias, CASE WHEN alias = 'extra 20' AND EXISTS (SELECT 1 FROM new WHERE id = 21) THEN 21 ELSE owner END AS owner, CASE WHEN alias = 'extra 20' AND EXISTS (SELECT 1 FROM new WHERE id = 21) THEN 'explicit' ELSE how END AS how, snapshot FROM firsts""")
def alias_ownership(spark, d):
    """O-J3: two old snapshots with aliases of their own, and one explicit target."""
    part = read(spark, d, "part").select(F.col("p_brand").alias("city"), F.col("p_name").alias("name"), F.col("p_partkey").alias("id"))
    old, new = snapshots(spark, d)
    more = F.when(F.col("id") % 10 == 0, F.array(F.concat(F.lit("extra "), F.col("id").cast("string")))).otherwise(F.array().cast("array<string>"))
    explicit = spark.createDataFrame([("extra 20", 21), ("nowhere", -1)], "alias string, target long")
    return matching.alias_owners([s.withColumn("aliases", more) for s in (part.where("id % 4 <> 1"), old)], new, explicit)


@query("""SELECT p_partkey, p_brand || '|' || p_name || CASE WHEN row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) = 1 THEN '' ELSE '#' || p_partkey END AS key FROM part""")
def legacy_owner(spark, d):
    """O-W7."""
    return matching.legacy_owner(read(spark, d, "part"), "p_brand", "p_name", "p_partkey")


@query(f"""WITH {SNAPSHOTS}, a AS (SELECT *, row_number() OVER (PARTITION BY city, name ORDER BY id) AS rn, count(*) OVER (PARTITION BY city, name) AS n FROM old),
    b AS (SELECT *, row_number() OVER (PARTITION BY city, name ORDER BY id) AS rn, count(*) OVER (PARTITION BY city, name) AS m FROM new)
    SELECT a.city, a.name, a.id AS old_id, b.id AS new_id FROM a JOIN b USING (city, name, rn) WHERE n = m""")
def ordinal_pair(spark, d):
    """O-W8."""
    return matching.ordinal_pairs(*snapshots(spark, d), ["city", "name"], "id")


@query(f"WITH {SNAPSHOTS} SELECT city, id FROM old EXCEPT SELECT city, id FROM new")
def alias_complete(spark, d):
    """O-J7: old keys without a current owner."""
    old, new = snapshots(spark, d)
    return matching.unowned(old, new, ["city", "id"])


@query("""SELECT doc_id, CASE WHEN good THEN 'kept ' || quality ELSE 'made ' || length(text) END AS value, CASE WHEN good THEN 'curated' ELSE 'generated' END AS source
    FROM (SELECT *, coalesce(quality = 1 AND doc_id % 4 <> 3 AND doc_id % 6 <> 5, FALSE) AS good FROM documents LEFT JOIN labels USING (doc_id))""")
def curated_override(spark, d):
    """O-J4: labels made for the current text, on the same date, beat the generated value."""
    docs = read(spark, d, "documents").select("doc_id", F.concat(F.lit("made "), F.length("text")).alias("value"), F.md5("text").alias("hash"), F.lit("2024-05-01").alias("checked"))
    labels = read(spark, d, "labels").where("quality = 1").join(docs.select("doc_id", "hash"), "doc_id")
    labels = labels.select("doc_id", F.concat(F.lit("kept "), F.col("quality")).alias("value"), F.when(F.col("doc_id") % 4 == 3, "old").otherwise(F.col("hash")).alias("hash"), F.when(F.col("doc_id") % 6 == 5, "2024-04-01").otherwise("2024-05-01").alias("checked"))
    return worksets.curated_override(docs, labels, "doc_id", "value", "hash", "checked")


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'unexpected' WHEN l.doc_id IS NULL THEN 'missing' ELSE 'matched' END AS state
    FROM (SELECT doc_id FROM documents WHERE doc_id % 10 <> 0) d FULL JOIN labels l ON d.doc_id = l.doc_id""")
def key_reconcile(spark, d):
    """O-J5."""
    return worksets.reconcile(read(spark, d, "documents").where("doc_id % 10 <> 0"), read(spark, d, "labels"), "doc_id")


@query("""WITH state AS (SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.doc_id IS NULL AS unexpected, l.doc_id IS NULL AS missing FROM (SELECT doc_id FROM documents WHERE doc_id % 10 <> 0) d FULL JOIN labels l ON d.doc_id = l.doc_id)
    SELECT mode, CAST(doc_id AS VARCHAR) AS key, CASE WHEN missing THEN 'missing-context' ELSE 'unexpected-context' END AS code FROM state, (VALUES ('strict'), ('partial')) AS m(mode) WHERE unexpected OR (missing AND mode = 'strict')""")
def reconcile_mode(spark, d):
    """O-Q16: strict and partial mode."""
    state = worksets.reconcile(read(spark, d, "documents").where("doc_id % 10 <> 0"), read(spark, d, "labels"), "doc_id")
    mode = lambda strict: worksets.reconcile_issues(state, "doc_id", strict).withColumn("mode", F.lit("strict" if strict else "partial"))
    return mode(True).unionByName(mode(False))


@query("""SELECT doc_id, CASE WHEN stored IS NULL THEN 'new' ELSE 'changed' END AS why FROM (SELECT doc_id, sha256(text) AS hash, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN sha256(text) ELSE sha256(text || 'x') END AS stored FROM documents)
    WHERE stored IS DISTINCT FROM hash""")
def stale_workset(spark, d):
    """O-J6."""
    docs = read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"), F.sha2(F.concat("text", F.lit("x")), 256).alias("other"))
    stored = docs.where("doc_id % 3 <> 0").select("doc_id", F.when(F.col("doc_id") % 3 == 1, F.col("hash")).otherwise(F.col("other")).alias("hash"))
    return worksets.stale_keys(docs.select("doc_id", "hash"), stored, "doc_id", "hash")


@query("""SELECT doc_id, CASE WHEN quality IS NULL THEN 'remaining' ELSE 'again' END AS todo FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality = 0""")
def queue_remainder(spark, d):
    """O-J10: what was never judged, and what was judged bad."""
    return worksets.work_left(read(spark, d, "documents").select("doc_id"), read(spark, d, "labels"), "doc_id", "quality", [0])


@query("""WITH a AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0), b AS (SELECT doc_id FROM labels), c AS (SELECT doc_id FROM documents WHERE doc_id % 5 <> 1), every AS (SELECT * FROM a UNION SELECT * FROM b UNION SELECT * FROM c)
    SELECT 'inventory' AS "table", doc_id FROM every WHERE doc_id NOT IN (SELECT doc_id FROM a) UNION ALL SELECT 'briefs', doc_id FROM every WHERE doc_id NOT IN (SELECT doc_id FROM b) UNION ALL SELECT 'prices', doc_id FROM every WHERE doc_id NOT IN (SELECT doc_id FROM c)""")
def key_set_equality(spark, d):
    """O-U2."""
    docs = read(spark, d, "documents").select("doc_id")
    return worksets.key_set_issues({"inventory": docs.where("doc_id % 2 = 0"), "briefs": read(spark, d, "labels"), "prices": docs.where("doc_id % 5 <> 1")}, "doc_id")


@query("""SELECT 'only first' AS side, p_name FROM (SELECT p_name FROM part WHERE p_size < 6 EXCEPT SELECT p_name FROM part WHERE p_size > 45) UNION ALL
    SELECT 'only second', p_name FROM (SELECT p_name FROM part WHERE p_size > 45 EXCEPT SELECT p_name FROM part WHERE p_size < 6) UNION ALL SELECT 'both', p_name FROM (SELECT p_name FROM part WHERE p_size < 6 INTERSECT SELECT p_name FROM part WHERE p_size > 45)""")
def set_differences(spark, d):
    """O-U3, O-U4: differences both ways and the intersection that should be empty."""
    part = read(spark, d, "part")
    return worksets.set_sides(part.where("p_size < 6"), part.where("p_size > 45"), "p_name")


@query("""WITH old AS (SELECT c_custkey AS key, c_acctbal AS v, row_number() OVER (ORDER BY c_custkey) AS ordinal FROM customer WHERE c_nationkey < 12),
    new AS (SELECT c_custkey AS key, c_acctbal + 1 AS v, row_number() OVER (ORDER BY c_custkey DESC) AS ordinal FROM customer WHERE c_nationkey BETWEEN 10 AND 15)
    SELECT coalesce(o.key, n.key) AS key, coalesce(n.v, o.v) AS v, coalesce(o.ordinal, (SELECT max(ordinal) FROM old) + n.ordinal) AS ordinal FROM old o FULL JOIN new n ON o.key = n.key""")
def upsert_keep_order(spark, d):
    """O-S8."""
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_nationkey", F.col("c_acctbal").alias("v"))
    from wayforge.operators.ranking import batched

    old = batched(c.where("c_nationkey < 12").select("key", "v"), 1, F.col("key")).withColumnRenamed("position", "ordinal").drop("batch")
    new = batched(c.where("c_nationkey between 10 and 15").select("key", (F.col("v") + 1).alias("v")), 1, F.desc("key")).withColumnRenamed("position", "ordinal").drop("batch")
    return worksets.upsert_in_order(old, new, "key").select("key", "v", "ordinal")


@query("""WITH prior AS (SELECT user_id AS identity, min(event_type) AS category FROM events WHERE event_id % 3 <> 0 GROUP BY 1), cur AS (SELECT user_id AS identity, max(event_type) AS category FROM events WHERE user_id % 4 <> 0 GROUP BY 1),
    lost AS (SELECT * FROM prior WHERE category IN ('click', 'error'))
    SELECT c.identity, c.category, CASE WHEN l.category IS NOT NULL AND l.category <> c.category THEN l.category ELSE '' END AS also, FALSE AS restored FROM cur c LEFT JOIN lost l USING (identity)
    UNION ALL SELECT identity, category, '', TRUE FROM lost WHERE identity NOT IN (SELECT identity FROM cur)""")
def preserve_failed(spark, d):
    """O-S9: rows of categories that failed this time come back."""
    events, none = read(spark, d, "events"), F.array().cast("array<string>")
    prior = events.where("event_id % 3 <> 0").groupBy(F.col("user_id").alias("identity")).agg(F.min("event_type").alias("category")).withColumn("also", none)
    current = events.where("user_id % 4 <> 0").groupBy(F.col("user_id").alias("identity")).agg(F.max("event_type").alias("category")).withColumn("also", none)
    failed = spark.createDataFrame([("click",), ("error",)], "category string")
    return worksets.preserve_failed(prior, current, failed).withColumn("also", F.array_join("also", ","))


@query("SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey IN (3, 7) THEN c_acctbal * 2 ELSE c_acctbal END AS v FROM customer WHERE c_nationkey NOT IN (3, 7, 11) OR (c_nationkey <> 11 AND c_acctbal > 0)")
def partition_replace(spark, d):
    """O-S7, O-U1: three nations replaced, one of which has no rows any more, all others untouched."""
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey", F.col("c_acctbal").alias("v"))
    new = c.where("c_nationkey in (3, 7) and v > 0").withColumn("v", F.col("v") * 2)
    selected = read(spark, d, "nation").where("n_nationkey in (3, 7, 11)").select(F.col("n_nationkey").cast(c.schema["c_nationkey"].dataType).alias("c_nationkey"))
    return worksets.replace_partitions(c, new, "c_nationkey", selected).select("c_custkey", "c_nationkey", "v")


QUARANTINE = """rows_ AS (SELECT o_orderkey AS entity, CASE WHEN l_linenumber = 7 THEN NULL ELSE s_nationkey % 4 END AS got, c_nationkey % 4 AS wanted
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey),
    q AS (SELECT entity, count(*) AS returned, count(*) FILTER (got = wanted) AS accepted, count(*) FILTER (got IS DISTINCT FROM wanted) AS quarantined, count(*) FILTER (got IS NULL) AS missing_id,
        count(DISTINCT got) FILTER (got <> wanted) AS rejected FROM rows_ GROUP BY 1)"""


def identified(spark, d):
    rows = read(spark, d, "orders").select("o_orderkey", "o_custkey").join(read(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(read(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber"), F.col("l_orderkey") == F.col("o_orderkey")).join(read(spark, d, "supplier").select("s_suppkey", "s_nationkey"), F.col("s_suppkey") == F.col("l_suppkey"))
    return rows.select(F.col("o_orderkey").alias("entity"), F.when(F.col("l_linenumber") != 7, F.col("s_nationkey") % 4).alias("got"), (F.col("c_nationkey") % 4).alias("wanted"))


@query(f"WITH {QUARANTINE} SELECT entity, returned, accepted, quarantined, missing_id, rejected FROM q")
def quarantine_split(spark, d):
    """O-J11."""
    return worksets.quarantine(identified(spark, d), "entity", "got", "wanted")


@query(f"""WITH {QUARANTINE} SELECT entity, CASE entity % 6 WHEN 1 THEN 'sum' WHEN 2 THEN 'stored-total' ELSE 'source-total' END AS code FROM q WHERE entity % 6 IN (1, 2) OR (entity % 6 = 3 AND accepted > 0)""")
def quarantine_arith(spark, d):
    """O-Q10: counts of which every sixth has one thing changed."""
    q, k = worksets.quarantine(identified(spark, d), "entity", "got", "wanted"), F.col("entity") % 6
    q = q.withColumns({"returned": F.col("returned") + F.when(k == 1, 1).otherwise(0), "stored_total": F.col("accepted") + F.when(k == 2, 1).otherwise(0), "source_total": F.when(k == 3, F.col("accepted") - 1).otherwise(F.col("returned") + 5)})
    q = q.withColumn("source_total", F.greatest("source_total", F.lit(0)))
    return worksets.quarantine_issues(q, "entity")


@query("""WITH first AS (SELECT c_name AS name, 'c' AS src FROM customer), second AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN replace(s_name, 'Supplier', 'Customer') ELSE s_name END AS name FROM supplier),
    added AS (SELECT name, 's' AS src FROM second WHERE name NOT IN (SELECT name FROM first)), merged AS (SELECT * FROM first UNION ALL SELECT * FROM added)
    SELECT name, src, (SELECT count(*) FROM merged) = (SELECT count(*) FROM first) + (SELECT count(*) FROM second) - (SELECT count(*) FROM second WHERE name IN (SELECT name FROM first)) AS proven FROM merged""")
def merge_catalogs(spark, d):
    """O-U5: the second catalog's new rows follow the first; the counts prove it."""
    first = read(spark, d, "customer").select(F.col("c_name").alias("name"), F.lit("c").alias("src"))
    name = F.when(F.col("s_suppkey") % 2 == 0, F.replace("s_name", F.lit("Supplier"), F.lit("Customer"))).otherwise(F.col("s_name"))
    merged, proof = worksets.merge_catalogs(first, read(spark, d, "supplier").select(name.alias("name"), F.lit("s").alias("src")), "name")
    return merged.join(F.broadcast(proof.select("proven")))  # one row


@query("""WITH titles AS (SELECT c_custkey AS id, 'nation_' || CAST(c_nationkey + (c_custkey % 3) * 15 AS VARCHAR) AS title FROM customer), meta AS (SELECT lower(replace(n_name, '_', ' ')) AS title, n_regionkey AS region FROM nation),
    redirects AS (SELECT 'nation ' || CAST(n_nationkey + 25 AS VARCHAR) AS title, lower(replace(n_name, '_', ' ')) AS target FROM nation WHERE n_nationkey % 2 = 0), every AS (SELECT * FROM meta UNION ALL SELECT r.title, m.region FROM redirects r JOIN meta m ON r.target = m.title)
    SELECT id, region, region IS NULL AS unresolved FROM titles t LEFT JOIN every e ON replace(lower(t.title), '_', ' ') = e.title""")
def redirect_lookup(spark, d):
    """O-J16: titles found directly or through a redirect."""
    nation = read(spark, d, "nation")
    titles = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("nation_"), (F.col("c_nationkey") + (F.col("c_custkey") % 3) * 15).cast("string")).alias("title"))
    meta = nation.select(F.col("n_name").alias("title"), F.col("n_regionkey").alias("region"))
    redirects = nation.where("n_nationkey % 2 = 0").select(F.concat(F.lit("nation "), (F.col("n_nationkey") + 25).cast("string")).alias("title"), F.col("n_name").alias("target"))
    return inventory.redirected(titles, meta, redirects, "title").select("id", "region", "unresolved")


@query("""WITH bands(band, title, plural) AS (VALUES ('A', 'adult', 'adults'), ('N', 'child', 'children'), ('R', 'senior', 'seniors')), c AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT l_orderkey, string_agg(n || ' ' || CASE WHEN n = 1 THEN title ELSE plural END, ' and ' ORDER BY l_returnflag) AS party FROM c JOIN bands ON band = l_returnflag GROUP BY 1""")
def party_text(spark, d):
    """O-J12: counts by age band as text."""
    bands = spark.createDataFrame([("A", "adult", "adults"), ("N", "child", "children"), ("R", "senior", "seniors")], "l_returnflag string, title string, plural string")
    counts = read(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("n"))
    return inventory.party_text(counts, bands, "l_orderkey", "l_returnflag", "n")


@query("""WITH o AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 4 <> 0 THEN 'ok' ELSE 'failed' END AS status, CASE WHEN o_orderkey % 8 = 0 THEN 'pax_failed' WHEN o_orderkey % 4 = 0 THEN 'timeout' END AS reason, o_totalprice AS price FROM orders),
    l AS (SELECT l_orderkey AS key, count(*) AS n, min(l_extendedprice) AS price, l_orderkey % 5 <> 0 AS same, l_orderkey % 7 <> 0 AS dated, l_orderkey % 3 <> 0 AS party FROM lineitem GROUP BY 1)
    SELECT key, CASE WHEN status = 'ok' THEN price WHEN good THEN low END AS price, CASE WHEN status = 'ok' THEN 'primary' WHEN good THEN 'rendered-fallback' ELSE 'none' END AS provenance, CASE WHEN status <> 'ok' AND good THEN reason END AS reason
    FROM (SELECT o.*, l.price AS low, coalesce(reason = 'pax_failed' AND same AND dated AND party AND n > 0, FALSE) AS good FROM o LEFT JOIN l ON l.key = o.key)""")
def fallback_evidence(spark, d):
    """O-J13: rendered evidence counts only where the lookup failed for a listed reason and its own guards hold."""
    k = F.col("o_orderkey")
    primary = read(spark, d, "orders").select(k.alias("key"), F.when(k % 4 != 0, "ok").otherwise("failed").alias("status"), F.when(k % 8 == 0, "pax_failed").when(k % 4 == 0, "timeout").alias("reason"), F.col("o_totalprice").alias("price"), F.concat(F.lit("p:"), k.cast("string")).alias("identity"))
    n = F.col("l_orderkey")
    rendered = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("packages"), F.min("l_extendedprice").alias("price"))
    rendered = rendered.select(n.alias("key"), F.when(n % 5 != 0, F.concat(F.lit("p:"), n.cast("string"))).alias("identity"), F.when(n % 7 != 0, "2024-05-01").otherwise("May 2024").alias("checked_at"), F.lit("2024-06-01").alias("booking_date"), F.when(n % 3 != 0, "2 adults").otherwise(" ").alias("travelers"), "packages", "price")
    return pricing.with_fallback(primary, rendered, "key").select("key", "price", "provenance", "reason")


@query("""SELECT n_nationkey, n_name, row_number() OVER (ORDER BY n_nationkey DESC) <= 2 AS keep FROM nation""")
def release_retention(spark, d):
    """O-S11: nations as releases."""
    return worksets.latest_kept(read(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey")


@query("""WITH b AS (SELECT c_nationkey AS product, c_custkey AS band, c_acctbal >= 0 AS ind, c_mktsegment = 'BUILDING' AS adult, c_custkey % 4 + 1 AS least_, c_custkey % 6 AS most FROM customer),
    r AS (SELECT *, row_number() OVER (PARTITION BY product ORDER BY NOT ind, NOT adult, band) AS k FROM b WHERE most >= least_ AND most > 0) SELECT product, band, greatest(least(2, most), least_) AS travellers FROM r WHERE k = 1""")
def party_choice(spark, d):
    """O-W15: the first feasible band of each product, independent ones and adults first, and how many travel."""
    k = F.col("c_custkey")
    bands = read(spark, d, "customer").select(F.col("c_nationkey").alias("product"), k.alias("band"), (F.col("c_acctbal") >= 0).alias("independent"), (F.col("c_mktsegment") == "BUILDING").alias("is_adult"), (k % 4 + 1).alias("least"), (k % 6).alias("most"))
    return inventory.party_choice(bands, "product")


@query("""SELECT source, min_by(lang, (CASE WHEN lang = 'en' THEN 0 ELSE 1 END) * 1000000000 + doc_id) AS lang FROM documents WHERE lang IS NOT NULL GROUP BY 1""")
def preferred_value(spark, d):
    """O-W16: English if offered, else the first listed."""
    return inventory.preferred(read(spark, d, "documents"), "source", "lang", "doc_id")
