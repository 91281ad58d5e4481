"""Queries on prices, availability and dates of packages."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayforge.operators import audits, pricing
from wayforge.plans.registry import query, read, tasks_for

PACKAGES = """packages AS (SELECT l_partkey AS key, CASE WHEN l_quantity = 1 THEN 'free' WHEN l_quantity = 2 THEN 'date' ELSE 'numeric' END AS kind, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
    CASE WHEN l_partkey % 5 = 0 AND l_suppkey % 2 = 0 THEN 'HUF' ELSE 'EUR' END AS currency, CASE WHEN l_partkey % 3 = 0 AND l_linestatus = 'F' THEN 'group' ELSE 'adult' END AS unit, 'admission' AS scope,
    CASE l_returnflag WHEN 'A' THEN 'available' WHEN 'R' THEN 'sold-out' END AS availability, CASE WHEN l_partkey % 13 = 0 AND l_linenumber = 1 THEN 'closed' WHEN l_partkey % 11 = 0 AND l_linenumber = 2 THEN 'unavailable' END AS global_state, l_quantity, l_linenumber
    FROM lineitem)"""


def packages(spark, d):
    li = read(spark, d, "lineitem")
    return li.select(
        F.col("l_partkey").alias("key"), F.when(F.col("l_quantity") == 1, "free").when(F.col("l_quantity") == 2, "date").otherwise("numeric").alias("kind"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.when((F.col("l_partkey") % 5 == 0) & (F.col("l_suppkey") % 2 == 0), "HUF").otherwise("EUR").alias("currency"), F.when((F.col("l_partkey") % 3 == 0) & (F.col("l_linestatus") == "F"), "group").otherwise("adult").alias("unit"),
        F.lit("admission").alias("scope"), F.when(F.col("l_returnflag") == "A", "available").when(F.col("l_returnflag") == "R", "sold-out").alias("availability"),
        F.when((F.col("l_partkey") % 13 == 0) & (F.col("l_linenumber") == 1), "closed").when((F.col("l_partkey") % 11 == 0) & (F.col("l_linenumber") == 2), "unavailable").alias("global_state"), "l_quantity", "l_linenumber",
    )


@query("""WITH c AS (SELECT l_orderkey AS key, sum(CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(18,2))) AS s, count(*) AS lines, min(cur) AS a, max(cur) AS b
        FROM (SELECT *, CASE WHEN l_orderkey % 7 = 0 THEN 'HUF' WHEN l_orderkey % 11 = 0 AND l_linenumber = 2 THEN 'USD' ELSE 'EUR' END AS cur FROM lineitem) GROUP BY 1),
    t AS (SELECT key, s + CASE key % 6 WHEN 0 THEN 0.04 WHEN 1 THEN 0.15 WHEN 2 THEN 0.9 WHEN 3 THEN 1.5 ELSE 0 END AS total FROM c)
    SELECT key, CASE WHEN a <> b THEN 'mixed-currency' ELSE 'price-math' END AS code FROM c JOIN t USING (key) WHERE a <> b OR abs(s - total) > CASE WHEN a = 'HUF' THEN 1 ELSE greatest(0.05, lines * 0.02) END""")
def charge_reconcile(spark, d):
    """O-A5."""
    cur = F.when(F.col("l_orderkey") % 7 == 0, "HUF").when((F.col("l_orderkey") % 11 == 0) & (F.col("l_linenumber") == 2), "USD").otherwise("EUR")
    charges = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), cur.alias("currency"), F.col("l_quantity").cast("bigint").alias("n"), F.col("l_extendedprice").cast("decimal(18,2)").alias("unit_price"))
    k = F.col("key") % 6
    off = F.when(k == 0, "0.04").when(k == 1, "0.15").when(k == 2, "0.90").when(k == 3, "1.50").otherwise("0").cast("decimal(18,2)")
    totals = charges.groupBy("key").agg(F.sum(F.col("n") * F.col("unit_price")).alias("total")).withColumn("total", F.col("total") + off)
    return pricing.charge_issues(charges, totals, "key")


@query("""WITH c AS (SELECT l_orderkey AS key, sum(CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(18,2))) AS s FROM lineitem GROUP BY 1)
    SELECT key, CAST(s AS DOUBLE) AS summed FROM c WHERE key % 10 = 0""")
def line_item_exact(spark, d):
    """O-A6: a cent off is an issue; every tenth stored total is one cent off."""
    lines = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_quantity").cast("bigint").alias("n"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    off = F.when(F.col("key") % 10 == 0, "0.01").otherwise("0").cast("decimal(18,2)")
    stored = lines.groupBy("key").agg(F.sum(F.col("n") * F.col("price")).alias("total")).withColumn("total", F.col("total") + off)
    return pricing.exact_line_issues(lines, stored, "key").select("key", F.col("summed").cast("double").alias("summed"))


@query(f"""WITH {PACKAGES}, o AS (SELECT * FROM packages WHERE availability IS DISTINCT FROM 'sold-out'),
    a AS (SELECT key, count(*) AS n, count(*) FILTER (kind = 'free') AS free, count(*) FILTER (kind = 'numeric') AS num, min(amount) FILTER (kind = 'numeric' AND availability = 'available') AS s0, count(DISTINCT currency || unit) FILTER (kind = 'numeric' AND availability = 'available') AS s1,
        min(amount) FILTER (kind = 'numeric') AS n0, count(DISTINCT currency || unit) FILTER (kind = 'numeric') AS n1 FROM o GROUP BY 1),
    r AS (SELECT k.key, CASE WHEN n IS NULL THEN 'No selectable options' WHEN free > 0 AND num > 0 THEN 'Free and paid options' WHEN free > 0 AND free < n THEN 'Free and date-dependent options' WHEN free > 0 THEN 'Free'
        WHEN num = 0 OR (CASE WHEN s0 IS NOT NULL THEN s1 ELSE n1 END) <> 1 THEN 'Prices vary' ELSE 'From' END AS outcome, coalesce(s0, n0) AS low FROM (SELECT DISTINCT key FROM packages) k LEFT JOIN a USING (key))
    SELECT key, outcome, CAST(CASE WHEN outcome = 'From' THEN low END AS DOUBLE) AS floor FROM r""")
def price_floor(spark, d):
    """O-A7."""
    return pricing.price_floor(packages(spark, d), "key").withColumn("floor", F.col("floor").cast("double"))


@query(f"""WITH {PACKAGES}, q AS (SELECT * REPLACE (CASE WHEN key % 4 = 0 AND l_linenumber % 2 = 0 THEN '' ELSE scope END AS scope) FROM packages WHERE kind = 'numeric'),
    bases AS (SELECT p_partkey AS key, CAST(p_retailprice * 10 AS DECIMAL(18,2)) AS base, CASE WHEN p_partkey % 6 = 0 THEN 'deposit' ELSE '' END AS own FROM part),
    b AS (SELECT key, min(amount) FILTER (fit) AS low, min(unit) FILTER (fit) AS u, max(unit) FILTER (fit) AS v, arg_min(scope, (amount, unit, scope)) FILTER (fit) AS bs, min(scope) AS s, max(scope) AS t FROM (SELECT *, availability = 'available' AND currency = 'EUR' AS fit FROM q) GROUP BY 1),
    r AS (SELECT *, coalesce(u = v AND u NOT IN ('', 'group') AND low < base, FALSE) AS better FROM bases LEFT JOIN b USING (key))
    SELECT key, CAST(CASE WHEN better THEN low ELSE base END AS DOUBLE) AS amount, CASE WHEN better THEN u ELSE '' END AS unit, CASE WHEN s = t AND s <> '' THEN s WHEN better AND bs <> '' THEN bs ELSE own END AS scope FROM r""")
def starting_price(spark, d):
    """O-A8."""
    own = F.when(F.col("p_partkey") % 6 == 0, "deposit").otherwise("")
    bases = read(spark, d, "part").select(F.col("p_partkey").alias("key"), (F.col("p_retailprice") * 10).cast("decimal(18,2)").alias("base"), F.lit("EUR").alias("currency"), own.alias("scope"))
    some = packages(spark, d).withColumn("scope", F.when((F.col("key") % 4 == 0) & (F.col("l_linenumber") % 2 == 0), "").otherwise(F.col("scope")))
    return pricing.starting_price(bases, some, "key").withColumn("amount", F.col("amount").cast("double"))


#: What a page says (every n-th part has it), where, and the state that it stands for.
SAID = [(13, "top-commerce", "This place is temporarily closed."), (11, "banner", "Currently unavailable"), (5, "call-to-action", "Reserve now"), (7, "title", "Select a date to continue"), (17, "banner", "Closed now, opens at 9")]
GRADE_SQL = "CASE l_returnflag WHEN 'A' THEN 'available' WHEN 'R' THEN CASE WHEN l_linenumber = 1 THEN 'closed' ELSE 'sold-out' END END"


def grade():
    return F.when(F.col("l_returnflag") == "A", "available").when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), "closed").when(F.col("l_returnflag") == "R", "sold-out")


@query(f"""WITH p AS (SELECT l_partkey AS key, coalesce(bool_or(a = 'available'), FALSE) AS any_, bool_and(coalesce(a = 'sold-out', FALSE)) AS out, bool_and(coalesce(a IN ('sold-out', 'closed'), FALSE)) AS neg FROM (SELECT l_partkey, {GRADE_SQL} AS a FROM lineitem) GROUP BY 1),
    k AS (SELECT l_partkey AS key FROM lineitem UNION SELECT p_partkey FROM part WHERE p_partkey % 13 = 0 OR p_partkey % 11 = 0 OR p_partkey % 5 = 0 OR p_partkey % 7 = 0 OR p_partkey % 17 = 0),
    m AS (SELECT k.key, p.*, exists(SELECT 1 FROM part WHERE p_partkey = k.key) AS has FROM k LEFT JOIN p ON p.key = k.key),
    r AS (SELECT key, CASE WHEN has AND key % 13 = 0 THEN 'closed|top-commerce' WHEN has AND key % 11 = 0 THEN 'unavailable|banner' WHEN any_ THEN 'available|packages' WHEN out THEN 'sold-out|packages' WHEN neg THEN 'unavailable|packages' WHEN has AND key % 5 = 0 THEN 'available|call-to-action' WHEN has AND key % 7 = 0 THEN 'date-required|title' ELSE 'unknown|' END AS x FROM m)
    SELECT key, split_part(x, '|', 1) AS availability, split_part(x, '|', 2) AS source FROM r""")
def availability_rollup(spark, d):
    """O-A10."""
    key = F.col("p_partkey")
    said = F.explode(F.array_compact(F.array(*(F.when(key % n == 0, F.struct(F.lit(scope).alias("scope"), F.lit(text).alias("text"))) for n, scope, text in SAID))))
    messages = read(spark, d, "part").select(key.alias("key"), said.alias("m")).select("key", "m.*")
    grades = read(spark, d, "lineitem").select(F.col("l_partkey").alias("key"), grade().alias("availability"))
    return pricing.availability_rollup(messages, grades, "key")


@query(f"""WITH g AS (SELECT l_partkey AS key, {GRADE_SQL} AS a, l_linenumber % 3 IN (1, 2) AS numbered FROM lineitem), n AS (SELECT key, bool_or(numbered) AS numeric FROM g GROUP BY 1),
    f AS (SELECT p_partkey AS key, CASE WHEN p_size % 4 = 1 THEN p_retailprice END AS base, CASE p_size % 8 WHEN 2 THEN 'free' WHEN 3 THEN 'not-published' WHEN 4 THEN 'unavailable' WHEN 5 THEN 'date-required' WHEN 6 THEN 'priced' ELSE '' END AS status, p_size % 3 <> 1 AND (p_size % 5 = 0 OR p_size % 11 = 0 OR p_size % 13 = 0 OR p_size % 8 = 6) AS failed, p_partkey % 2 = 0 AS product, p_partkey % 5 = 0 AS free FROM part),
    s AS (SELECT f.*, status = 'free' OR (NOT product AND free) AS gratis, CASE WHEN status = 'unavailable' AND NOT failed THEN 'unavailable' WHEN base > 0 OR (coalesce(numeric, FALSE) AND NOT failed) THEN 'priced' WHEN failed THEN 'date-required' WHEN status IN ('free', 'date-required', 'not-published') THEN status WHEN product THEN 'date-required' WHEN free THEN 'free' ELSE 'not-published' END AS state FROM f LEFT JOIN n USING (key)),
    p AS (SELECT s.key, count(*) AS n, count(*) FILTER (CASE WHEN a IN ('sold-out', 'closed') OR state = 'unavailable' THEN FALSE WHEN a = 'available' OR numbered THEN TRUE ELSE FALSE END) AS v FROM s JOIN g USING (key) WHERE state <> 'not-published' GROUP BY 1)
    SELECT key, state, failed, coalesce(n, 0) + CASE WHEN gratis AND state <> 'unavailable' THEN 1 ELSE 0 END AS options, coalesce(v, 0) + CASE WHEN gratis AND state <> 'unavailable' THEN 1 ELSE 0 END AS available FROM s LEFT JOIN p USING (key)""")
def price_state(spark, d):
    """O-A9: the state of each price, and its packages as the state leaves them."""
    size, key, n, price = F.col("p_size"), F.col("p_partkey"), F.col("l_linenumber") % 3, F.col("l_extendedprice").cast("decimal(18,2)")
    status = F.when(size % 8 == 2, "free").when(size % 8 == 3, "not-published").when(size % 8 == 4, "unavailable").when(size % 8 == 5, "date-required").when(size % 8 == 6, "priced").otherwise("")
    facts = read(spark, d, "part").select(
        key.alias("key"), F.when(size % 4 == 0, F.lit(0.0)).when(size % 4 == 1, F.col("p_retailprice")).alias("base"), status.alias("status"), F.when(size % 3 == 0, "unknown").when(size % 3 == 1, "available").otherwise("unavailable").alias("availability"), F.when(size % 5 == 0, "pax_failed").alias("reason"),
        F.when(size % 11 == 0, "graphql:paxMix").alias("source"), F.when(size % 13 == 0, "The package option lookup failed").alias("message"), (key % 2 == 0).alias("is_product"), (key % 5 == 0).alias("free"),
    )
    packs = read(spark, d, "lineitem").select(
        F.col("l_partkey").alias("key"), F.col("l_orderkey").alias("ord"), F.concat(F.lit("Option "), F.col("l_linenumber").cast("string")).alias("name"), grade().alias("availability"), F.when(n == 1, price).alias("unit_price"), F.when(n != 0, price).alias("total_price"), F.lit("adult").alias("unit"),
    )
    states, shown = pricing.price_states(facts, packs, "key")
    per = shown.groupBy("key").agg(F.count("*").alias("options"), F.count_if(F.col("availability") == "available").alias("available"))
    return states.join(per, "key", "left").select("key", "state", "failed", F.coalesce("options", F.lit(0)).alias("options"), F.coalesce("available", F.lit(0)).alias("available"))


#: Changes of one thing in a valid price or package, and the one code that each gives; every 26th part has the same.
PRICE_FAULTS = {1: ("travelers", None), 2: ("availability", "open"), 3: ("message", ""), 4: ("status", "free"), 5: ("base_price", "NaN"), 8: ("availability", "sold-out"), 11: ("availability", "closed"), 20: ("availability", "sold-out")}
PACKAGE_FAULTS = {6: ("unit", ""), 7: ("availability", "gone"), 8: ("availability", "sold-out"), 9: ("total_price", "$5"), 12: ("availability", "sold-out"), 15: ("description", None), 20: ("availability", "sold-out")}
CODES = {
    1: "pricing-field", 2: "availability-status", 3: "availability-field", 4: "pricing-status", 5: "pricing-nan", 6: "package-unit", 7: "package-availability", 8: "package-availability-message", 9: "standalone-total", 10: "package-duplicate", 11: "package-global-contradiction",
    12: "package-global-availability", 13: "additional-cost", 14: "additional-cost-unit", 15: "package-field", 16: "pricing-provenance-kind", 17: "pricing-provenance-identity", 18: "pricing-provenance-date", 19: "pricing-provenance-reason",
}


def planted_sql(codes: dict, n: int) -> str:
    return f"SELECT p_partkey AS key, code FROM part JOIN (VALUES {', '.join(f"({k}, '{c}')" for k, c in codes.items())}) AS v(k, code) ON p_partkey % {n} = k"


def changed(valid: dict, faults: dict, k) -> list:
    """The valid columns, each with the values that the faults give it."""
    out = []
    for name, value in valid.items():
        column = F.lit(value)
        for i, (c, v) in faults.items():
            column = F.when(k == i, F.lit(v)).otherwise(column) if c == name else column
        out.append(column.cast("string").alias(name))
    return out


@query(planted_sql(CODES, 26))
def pricing_invariants(spark, d):
    """O-Q5: one change, one code."""
    k = F.col("p_partkey") % 26
    valid = {"status": "available", "availability": "available", "message": "ok", "source": "page", "reason": "", "base_price": "$10", "booking_date": "2024-05-01", "travelers": "2"}
    part = read(spark, d, "part")
    prices = part.select(F.col("p_partkey").alias("key"), k.alias("k"), *changed(valid, PRICE_FAULTS, k))
    prices = prices.withColumns({"status": F.when(F.col("k") == 2, None).when(F.col("k").isin(8, 11), "unavailable").when(F.col("k") == 20, None).otherwise(F.col("status")), "reason": F.when(F.col("k") == 20, "pax_failed").otherwise("")})
    proof = F.struct(F.when(F.col("k") == 16, "other").otherwise("rendered-fallback").alias("kind"), (F.col("k") != 17).alias("same_identity"), F.when(F.col("k") == 18, "2024-13-01").otherwise("2024-05-01").alias("checked_at"), F.when(F.col("k") == 19, "other").otherwise("pax_failed").alias("failure"))
    prices = prices.withColumn("provenance", F.when(F.col("k") >= 16, proof)).drop("k")
    package = {"name": "Tour", "description": "A tour", "total_price": "", "party": "", "unit_price": "$10", "unit": "adult", "availability": "available", "availability_message": ""}
    extra = lambda a, u: F.array(F.struct(F.lit(a).alias("amount"), F.lit("text").alias("source_text"), F.lit(u).alias("unit")))
    packages_ = part.select(F.col("p_partkey").alias("key"), k.alias("k"), *changed(package, PACKAGE_FAULTS, k))
    packages_ = packages_.withColumns({"availability_message": F.when(F.col("k").isin(12, 20), "Sold out").otherwise(""), "extras": F.when(F.col("k") == 13, extra("", "person")).when(F.col("k") == 14, extra("$2", " ")).otherwise(extra("$2", "person"))})
    again = packages_.where("k = 10")
    return pricing.pricing_issues(prices, packages_.union(again).drop("k"), "key")


@query("""SELECT o_custkey, CAST(day AS VARCHAR) AS day, rank FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day, dense_rank() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)) AS rank
    FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01' + CAST(greatest(1, ceil((o_custkey % 60) / 24) + 1) AS INTEGER) AND o_totalprice >= 0) WHERE rank <= 5""")
def earliest_dates(spark, d):
    """O-W9: the first five valid dates after each product's own cut-off."""
    o = read(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    out = audits.earliest_dates(o, "o_custkey", "o_orderdate", F.col("o_totalprice"), F.lit("1996-01-01").cast("date"), F.col("o_custkey") % 60)
    return out.select("o_custkey", F.col("day").cast("string").alias("day"), "rank")


@query("""SELECT conv_id, bool_and(turn = rn - 1) AS numbered, coalesce(bool_or(last_role = 'assistant'), FALSE) AS after_settled FROM
    (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS last_role FROM conversations) GROUP BY 1""")
def attempt_sequence(spark, d):
    """O-W10: attempts numbered without gaps, none after a settled one."""
    return audits.attempt_order(read(spark, d, "conversations"), "conv_id", "turn", F.col("turn") + 1, F.col("role") == "assistant").select("conv_id", "numbered", "after_settled")


@query("""WITH o AS (SELECT o_custkey, list_sort(list(DISTINCT o_orderkey)) AS advertised, list_sort(list(DISTINCT o_orderkey) FILTER (o_orderstatus <> 'P')) AS attempted FROM orders GROUP BY 1)
    SELECT o_custkey, len(coalesce(attempted, [])) AS k, coalesce(attempted, []) = advertised[1:len(coalesce(attempted, []))] AS is_prefix FROM o""")
def attempted_prefix(spark, d):
    """O-W12: what was attempted is the first part of what was advertised."""
    o = read(spark, d, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderstatus") != "P").alias("attempted"))
    return audits.attempted_prefix(o, "o_custkey", "o_orderkey", "attempted")


@query("""SELECT p_partkey, least(10, n) AS target, got, got >= least(10, n) AS covered FROM part JOIN (SELECT l_partkey, greatest(count(*), max(l_linenumber) * 3) AS n, count(DISTINCT l_returnflag || l_linestatus || l_quantity) AS got FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""")
def coverage_target(spark, d):
    """O-A4: ten unique reviews, or all if the largest total shown is smaller."""
    have = read(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("a"), (F.max("l_linenumber") * 3).alias("b"), F.count_distinct("l_returnflag", "l_linestatus", "l_quantity").alias("got"))
    rows = read(spark, d, "part").join(have, F.col("l_partkey") == F.col("p_partkey")).withColumn("none", F.lit(None).cast("long"))
    return audits.coverage(rows, "p_partkey", ["a", "b"], "none", "got")


REVIEWS_SQL = "r AS (SELECT l_partkey AS key, l_returnflag || l_linestatus AS title, CASE WHEN l_quantity = 1 THEN NULL ELSE CAST(l_quantity AS VARCHAR) END AS text, l_linenumber - 1 AS rating FROM lineitem)"


@query(f"""WITH {REVIEWS_SQL}, x AS (SELECT key, CASE WHEN text IS NULL THEN '' ELSE title END AS title, coalesce(text, '') AS text, rating FROM r), g AS (SELECT key, title, text, count(*) AS n FROM x GROUP BY ALL)
    SELECT key, 'reviews-limit' AS code FROM x GROUP BY key HAVING count(*) > 10 UNION ALL SELECT DISTINCT key, 'review-duplicate' FROM g WHERE n > 1 UNION ALL SELECT DISTINCT key, 'review-empty' FROM x WHERE title = '' AND text = '' UNION ALL SELECT DISTINCT key, 'review-rating' FROM x WHERE rating NOT BETWEEN 1 AND 5
    UNION ALL SELECT key, 'review-coverage' FROM (SELECT key, sum(n) AS n, count(*) AS u FROM g GROUP BY 1) JOIN part ON p_partkey = key WHERE u < least(10, n) AND p_size <> 7
    UNION ALL SELECT p_partkey, CASE p_size % 10 WHEN 3 THEN 'review-language-missing' WHEN 4 THEN 'review-language' ELSE 'review-filter' END FROM part WHERE p_size % 10 IN (3, 4, 5) AND p_partkey IN (SELECT key FROM x)""")
def review_set_audit(spark, d):
    """O-Q4, O-Q8: limits, empty and repeated reviews, ratings, coverage with listed exceptions, languages and filters."""
    empty = F.col("l_quantity") == 1
    r = read(spark, d, "lineitem").select(F.col("l_partkey").alias("key"), F.when(empty, "").otherwise(F.concat("l_returnflag", "l_linestatus")).alias("title"), F.when(empty, "").otherwise(F.col("l_quantity").cast("string")).alias("text"), (F.col("l_linenumber") - 1).alias("rating"))
    per = r.groupBy("key").agg(F.count("*").alias("n"), F.count_distinct("title", "text").alias("u"))
    part, digit = read(spark, d, "part"), F.col("p_size") % 10
    rows = part.join(per, F.col("p_partkey") == F.col("key")).select("key", "n", "u", F.when(digit != 3, "all").alias("languages"), (digit != 4).alias("all_languages"), F.when(digit == 5, "english only").alias("filter"), F.lit(None).cast("long").alias("none"))
    rows = rows.join(audits.coverage(rows, "key", ["n"], "none", "u").select("key", "covered"), "key")
    excused = part.where("p_size = 7").select(F.col("p_partkey").alias("key"))
    return audits.review_issues(r, "key").union(audits.coverage_issues(rows, "key", excused))


@query(f"""WITH o AS (SELECT o_orderkey AS key, o_custkey % 4 AS c, CAST(o_totalprice AS DECIMAL(18,2)) AS base FROM orders), g AS (SELECT l_orderkey AS key, CASE WHEN l_orderkey % 9 = 8 THEN 0 WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_extendedprice END AS amount, l_returnflag = 'R' AS out FROM lineitem),
    a AS (SELECT key, count(*) AS n, max(amount) AS most, bool_and(out) AS neg FROM g GROUP BY 1)
    SELECT key, CASE WHEN c <> 0 THEN CAST(base AS DOUBLE) END AS base, CASE c WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' WHEN 3 THEN 'GBP' END AS currency, coalesce(n, 0) AS packages, CASE WHEN c = 0 THEN 'date-required' WHEN n IS NULL THEN 'unknown' WHEN neg THEN 'unavailable' WHEN most = 0 THEN 'free' WHEN most IS NULL THEN 'not-published' ELSE 'available' END AS state FROM o LEFT JOIN a USING (key)""")
def price_projection(spark, d):
    """O-P8: nested evidence; the base price of the chosen date, amounts under different names, inherited currencies."""
    nothing = F.col("o_orderkey") % 9 == 8

    def grade(line):
        n, value = line["l_linenumber"] % 4, F.when(nothing, F.lit(0.0)).otherwise(line["l_extendedprice"])
        given = lambda amount, total: F.struct(amount.cast("double").alias("amount"), total.cast("int").alias("total"))
        first = F.when(n == 1, given(value, F.lit(None))).when((n == 0) & nothing, given(F.lit(None), F.lit(0)))  # JSON leaves out what is null
        deep = F.when(n == 3, F.struct(F.struct(value.alias("value"), F.lit("huf").alias("currencyCode")).alias("displayPrice")))
        title = F.concat(F.lit("Option "), line["l_linenumber"].cast("string"))
        return F.struct(title.alias("title"), F.when(line["l_returnflag"] == "R", "Sold out").alias("status"), first.alias("price"), F.when(n == 2, F.struct(value.alias("price"))).alias("totalPrice"), deep.alias("pricing"))

    orders = read(spark, d, "orders")
    tasks = tasks_for(orders, 100_000)  # by rows: documents are far larger than the rows that they are made of, and take long
    lines = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag").repartition(tasks, "l_orderkey")
    lines = lines.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_extendedprice", "l_returnflag")).alias("lines"))  # an order has a few lines
    c, base = F.col("o_custkey") % 4, F.col("o_totalprice").cast("decimal(18,2)")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    row = F.when(c == 1, base.cast("variant")).when(c == 2, F.to_variant_object(F.struct(F.struct(base.alias("value"), F.lit("eur").alias("currency")).alias("price")))).otherwise(F.to_variant_object(F.struct(base.alias("amount"), F.lit("GBP").alias("currencyCode"))))
    calendar = F.array(F.struct(F.lit("1990-01-01").alias("date"), F.parse_json(F.lit("1")).alias("price")), F.struct(day.alias("date"), row.alias("price")))
    grades = F.transform("lines", grade).alias("grades")
    docs = orders.repartition(tasks, "o_orderkey").join(lines.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"), "left").select(F.col("o_orderkey").alias("key"), F.to_json(F.struct(F.when(c != 0, day).alias("travelDate"), calendar.alias("calendar"), grades)).alias("doc"))
    prices, _ = pricing.price_projection(docs, "key", "doc")
    return prices.withColumn("base", F.col("base").cast("double"))


RAW_CODES = {1: "raw-total-missing", 2: "raw-total-mismatch", 3: "raw-charge-missing", 4: "raw-charge-price-mismatch", 5: "raw-charge-unit-mismatch", 6: "raw-package-count", 7: "raw-base-price-missing", 8: "raw-base-price-mismatch", 9: "raw-priced-surface-empty"}
RAW_FAULTS = {1: ("total_price", ""), 2: ("total_price", "$72"), 3: ("unit", ""), 4: ("unit_price", "$36"), 5: ("unit", "seniors"), 9: ("total_price", ""), 10: ("total_price", "71,00 $")}


@query(planted_sql(RAW_CODES, 12))
def raw_vs_parsed(spark, d):
    """O-Q6: a second extraction from the page's text against what is stored; one change, one code."""
    k = F.col("p_partkey") % 12
    part = read(spark, d, "part").select(F.col("p_partkey").alias("key"), k.alias("k"))
    surface = F.when(F.col("k") == 9, "Book for $20 today").otherwise("Small group. 2 Adults x $35.50 Total price: $71.00 for 2 Adults.")
    raw = part.select("key", F.lit(0).alias("at"), surface.alias("surface")).union(part.select("key", F.lit(-1), F.lit("from $35.50")))
    valid = {"total_price": "$71.00", "unit_price": "$35.50", "unit": "adults", "availability": "available"}
    stored = part.select("key", F.lit(0).alias("at"), "k", *changed(valid, RAW_FAULTS, F.col("k"))).where("k <> 6")
    stored = stored.withColumns({c: F.when(F.col("k") == 9, "").otherwise(F.col(c)) for c in ("unit_price", "unit")}).drop("k")
    prices = part.select("key", F.when(F.col("k") == 7, "").when(F.col("k") == 8, "$30").otherwise("$35.50").alias("base_price"))
    return pricing.raw_price_issues(raw, stored, prices, "key")
