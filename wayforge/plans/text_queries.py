"""Queries on texts: hygiene, money, sentences, languages, copies.

Most run over the documents with planted sentences at their ends; the SQL knows what was planted, not how it is found."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayforge.functions import text as T
from wayforge.operators import inventory, textjobs
from wayforge.plans.registry import query, read

#: A price as it is written, and its (token, currency, amount).
MONEY = [
    ("€34,97", [("€34,97", "EUR", 34.97)]), ("1.234,56 €", [("1.234,56 €", "EUR", 1234.56)]), ("A$ 42.50", [("A$ 42.50", "AUD", 42.5)]), ("€1.23.4", [("€1.23.4", "EUR", None)]), ("CA$ 5", [("CA$ 5", "CAD", 5.0)]),
    ("3 500 Ft", [("3 500 Ft", "HUF", 3500.0)]), ("$1,234 and £7", [("$1,234", "USD", 1234.0), ("£7", "GBP", 7.0)]), ("USD 45", [("USD 45", "USD", 45.0)]), ("HUF 3500", [("HUF 3500", "HUF", 3500.0)]), ("12 EUR", [("12 EUR", "EUR", 12.0)]),
    ("NZD 50", [("NZD 50", "NZD", 50.0)]), ("5 000 €", [("5 000 €", "EUR", 5000.0)]), ("US$ 9.99", [("US$ 9.99", "USD", 9.99)]), ("nothing", []),
]
STATE = [
    ("An additional fee of €2 per person applies.", [("€2", "EUR", 2.0)]), ("Free admission.", []), ("Free admission for children only.", []), ("Sold out this week.", []), ("The hall is temporarily closed.", []), ("Please select a date.", []),
    ("Entry is free on Sundays.", []), ("Entrance is free of charge for all.", []), ("Admission is free, closed now.", []), ("Only here admission is free.", []),
]
SCOPE = [
    ("A deposit of €10 is due.", [("€10", "EUR", 10.0)]), ("This free walking tour has a price of €3.", [("€3", "EUR", 3.0)]), ("Closed now.", []), ("Guests over 12 pay from €15 per hour.", [("€15", "EUR", 15.0)]),
    ("Surcharges of $5 per adult are not included; a booking fee of €4 applies.", [("$5", "USD", 5.0), ("€4", "EUR", 4.0)]),
]
PARTS = (MONEY, STATE, SCOPE)


def planted(cases) -> F.Column:
    i = F.col("doc_id") % len(cases)
    return F.coalesce(*(F.when(i == k, text) for k, (text, _) in enumerate(cases)))


def priced(spark, d):
    """The documents without currency marks of their own, each with a price, a state and a sentence on a charge at its end."""
    text = F.concat(F.translate("text", "$€£¥", ""), F.lit(" Tickets cost "), planted(MONEY), F.lit(" each. "), planted(STATE), F.lit(" "), planted(SCOPE))
    return read(spark, d, "documents").select("doc_id", "lang", text.alias("text"), planted(SCOPE).alias("charge"))


def case_sql(cases, of=lambda text, tokens: text) -> str:
    return f"CASE doc_id % {len(cases)} " + " ".join(f"WHEN {k} THEN '{of(*c)}'" for k, c in enumerate(cases)) + " END"


def redacted(text, tokens):
    for t, *_ in tokens:
        text = text.replace(t, "[price]")
    return text


def tokens_sql(cases) -> str:
    rows = [f"({k}, '{t}', '{c}', CAST({'NULL' if a is None else a} AS DOUBLE))" for k, (_, tokens) in enumerate(cases) for t, c, a in tokens]
    return f"SELECT doc_id, token, currency, amount FROM documents JOIN (VALUES {', '.join(rows)}) AS v(k, token, currency, amount) ON doc_id % {len(cases)} = k WHERE text IS NOT NULL"


@query(" UNION ALL ".join(map(tokens_sql, PARTS)))
def price_mentions(spark, d):
    """O-X4."""
    return textjobs.mentions(priced(spark, d), "doc_id", "text").select("doc_id", "token", "currency", F.col("amount").cast("double").alias("amount"))


@query(f"SELECT doc_id, {' + '.join(case_sql(c, lambda text, tokens: len(tokens)).replace(chr(39), '') for c in PARTS)} AS n, md5(translate(text, '$€£¥', '') || ' Tickets cost ' || {case_sql(MONEY, redacted)} || ' each. ' || {case_sql(STATE, redacted)} || ' ' || {case_sql(SCOPE, redacted)}) AS redacted FROM documents WHERE text IS NOT NULL")
def redact_money(spark, d):
    """O-X5."""
    return priced(spark, d).where("text is not null").select("doc_id", F.size(T.money_mentions(F.col("text"))).alias("n"), F.md5(F.regexp_replace("text", T.MONEY, "[price]")).alias("redacted"))


@query("""SELECT doc_id, '€2' AS amount, 'person' AS unit, 'An additional fee of €2 per person applies.' AS sentence FROM documents WHERE doc_id % 10 = 0 AND text IS NOT NULL UNION ALL SELECT doc_id, '$5', 'adult', 'Surcharges of $5 per adult are not included;' FROM documents WHERE doc_id % 5 = 4 AND text IS NOT NULL""")
def surcharge(spark, d):
    """O-X6."""
    return textjobs.surcharges(priced(spark, d), "doc_id", "text")


@query("SELECT doc_id, text IS NOT NULL AND doc_id % 10 IN (1, 7, 8) AS free FROM documents")
def free_evidence(spark, d):
    """O-X7."""
    return priced(spark, d).select("doc_id", T.free_admission(F.col("text")).alias("free"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'deposit' WHEN 1 THEN 'booking-fee' WHEN 4 THEN 'booking-fee' ELSE '' END AS scope FROM documents WHERE text IS NOT NULL")
def charge_scope(spark, d):
    """O-X8: of the last charge that a text names."""
    p = priced(spark, d).where("text is not null")
    prices = F.transform(T.money_mentions(F.col("text")), lambda t: F.struct(T.currency(t).alias("c"), T.amount(t).alias("a")))
    last = p.select("doc_id", "text", "charge", F.try_element_at(prices, F.lit(-1)).alias("p"))
    return last.select("doc_id", T.charge_scope(F.col("charge"), F.col("text"), F.col("p.c"), F.col("p.a")).alias("scope"))


@query("SELECT doc_id, CASE WHEN text IS NULL THEN NULL WHEN doc_id % 10 = 3 THEN 'sold-out' WHEN doc_id % 10 = 4 AND doc_id % 5 <> 2 THEN 'closed' WHEN doc_id % 10 = 5 THEN 'date-required' END AS state FROM documents")
def availability_text(spark, d):
    """O-X9."""
    return priced(spark, d).select("doc_id", T.availability(F.col("text")).alias("state"))


#: What a package's text says besides its title, its title, whether it can be booked, and its state.
PACKAGES = [("Reserve now.", "Sold out museum tour", False, "available"), ("Sold out.", "City walk", True, "sold-out"), ("Not available today.", "City walk", False, "unavailable"), ("", "Unavailable treasures", True, "available"), ("Closed now.", "City walk", False, "unknown")]


@query(f"SELECT doc_id, state FROM documents JOIN (VALUES {', '.join(f"({i}, '{x[3]}')" for i, x in enumerate(PACKAGES))}) AS v(i, state) ON doc_id % {len(PACKAGES)} = i")
def package_states(spark, d):
    """O-X9: packages whose descriptions are whole documents; what they say themselves is no state."""
    pick = lambda n: F.coalesce(*(F.when(F.col("doc_id") % len(PACKAGES) == i, F.lit(x[n])) for i, x in enumerate(PACKAGES)))
    docs = read(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), pick(1).alias("title"))
    raw = F.concat_ws(" ", "title", "text", pick(0))
    return docs.select("doc_id", T.package_availability(raw, F.array("title", "text"), pick(2)).alias("state"))


@query("SELECT doc_id, text IS NOT NULL AND doc_id % 10 = 4 AS closed FROM documents")
def closed_flag(spark, d):
    """O-P7."""
    return priced(spark, d).select("doc_id", T.closed_for_long(F.col("text")).alias("closed"))


CLIP_SQL = r"trim(regexp_replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', ' ', 'g'), '[\s\x0B\x{85}\p{Z}]+', ' ', 'g'))"


@query(f"""WITH t AS (SELECT doc_id, {CLIP_SQL} AS t FROM documents), p AS (SELECT doc_id, t, t[1:300] AS h FROM t),
    w AS (SELECT doc_id, t, h, CASE WHEN regexp_matches(h, '[.!?…]$') THEN h ELSE regexp_extract(h, '(?s)^(.*[.!?…]) ', 1) END AS s, regexp_replace(regexp_replace(h, '(?s) [^ ]*$', ''), '[ ,;:-]+$', '') AS w FROM p)
    SELECT doc_id, CASE WHEN length(t) <= 300 THEN t WHEN length(s) >= 150 THEN s ELSE rtrim((CASE WHEN w = '' THEN h ELSE w END)[1:299]) || '…' END AS clipped,
        CASE doc_id % 7 WHEN 0 THEN 'Short text ' || doc_id WHEN 1 THEN repeat('abcd ', 40) || 'done.' WHEN 2 THEN 'One. ' || repeat('abcd ', 58) || 'abc…' WHEN 3 THEN repeat('漢', 299) || '…' WHEN 4 THEN 'a b c d' WHEN 5 THEN repeat('x', 149) || '…' ELSE repeat('y', 296) || '!?.' END AS planted FROM w""")
def clip_evidence(spark, d):
    """O-X3: all texts, and planted ones whose ends are known: early, late, none, at half, at the limit, odd white space."""
    k = F.col("doc_id") % 7
    planted = (
        F.when(k == 0, F.concat(F.lit("Short\u0007 \n text "), F.col("doc_id").cast("string"))).when(k == 1, F.lit("abcd " * 40 + "done. " + "xyz " * 60)).when(k == 2, F.lit("One. " + "abcd " * 58 + "abc, ;" + " abcd" * 9))
        .when(k == 3, F.lit("漢" * 600)).when(k == 4, F.lit("\u3000a\u2028b\u00a0c\u0085d")).when(k == 5, F.lit("x" * 149 + "… " + "z.z z" * 30 + "zz" * 90)).otherwise(F.lit("y" * 296 + "!?. And more."))
    )
    return read(spark, d, "documents").select("doc_id", T.clipped(F.col("text"), 300).alias("clipped"), T.clipped(planted, 300).alias("planted"))


FAULTS = {1: ("\x07", "text-control"), 2: ("\ufffd", "text-replacement"), 3: ("e\u0301", "text-nfc"), 4: ("  x", "text-space"), 5: ("\ufff9", "text-interlinear"), 6: (" ", "text-space")}


@query("SELECT doc_id, code FROM documents JOIN (VALUES " + ", ".join(f"({k}, '{code}')" for k, (_, code) in FAULTS.items()) + ") AS v(k, code) ON doc_id % 9 = k WHERE text IS NOT NULL")
def text_hygiene(spark, d):
    """O-X1: documents with a fault at the end of two in three."""
    fault = F.coalesce(*(F.when(F.col("doc_id") % 9 == k, x) for k, (x, _) in FAULTS.items()), F.lit(""))
    docs = read(spark, d, "documents").select("doc_id", F.concat("text", fault).alias("text"))
    return textjobs.issues(docs, "doc_id", textjobs.hygiene_rules(F.col("text")))


RULES = [(1, "tours", "free walking tour"), (2, "events", "(?i)tickets cost [^.]*£"), (3, "fees", "additional fee"), (4, "parks", "select a date"), (5, "food", "The hall")]


@query("""WITH c AS (SELECT doc_id FROM labels WHERE toxic = 1), r AS (SELECT doc_id, CASE WHEN text IS NULL THEN NULL WHEN doc_id % 5 = 1 THEN 'tours' WHEN doc_id % 14 = 6 THEN 'events' WHEN doc_id % 10 = 0 THEN 'fees' WHEN doc_id % 10 = 5 THEN 'parks' WHEN doc_id % 10 = 4 THEN 'food' END AS rule FROM documents)
    SELECT r.doc_id, CASE WHEN c.doc_id IS NOT NULL THEN 'hidden' ELSE coalesce(rule, 'review') END AS label, CASE WHEN c.doc_id IS NOT NULL THEN 'curated' WHEN rule IS NOT NULL THEN 'rule' ELSE 'none' END AS "by" FROM r LEFT JOIN c USING (doc_id)""")
def classify_rules(spark, d):
    """O-P2: an ordered rule table over whole texts, curated ids first."""
    curated = read(spark, d, "labels").where("toxic = 1").select("doc_id", F.lit("hidden").alias("label"))
    return textjobs.classify(priced(spark, d), "doc_id", "text", RULES, curated)


@query("""WITH n AS (SELECT count(*) AS n FROM customer), r AS (SELECT doc_id, text, least(doc_id % n, (doc_id * 7) % n) AS k FROM documents, n), c AS (SELECT doc_id FROM labels WHERE toxic = 1)
    SELECT r.doc_id, CASE WHEN c.doc_id IS NOT NULL THEN 'hidden' WHEN text IS NULL THEN 'review' WHEN r.doc_id % 11 = 0 THEN 'first' ELSE c_mktsegment END AS label, CASE WHEN c.doc_id IS NOT NULL THEN 'curated' WHEN text IS NULL THEN 'none' ELSE 'rule' END AS "by" FROM r JOIN customer ON c_custkey = k LEFT JOIN c ON c.doc_id = r.doc_id""")
def classify_phrases(spark, d):
    """O-P2: a literal rule for each customer, all found in one pass over whole texts; one pattern comes before them."""
    people, docs = read(spark, d, "customer"), read(spark, d, "documents")
    n = F.lit(people.count())
    named = lambda k, c: people.select(F.col("c_custkey").alias(k), F.upper("c_name").alias(c))
    rows = docs.select("doc_id", "text", (F.col("doc_id") % n).alias("k1"), ((F.col("doc_id") * 7) % n).alias("k2")).join(named("k1", "n1"), "k1").join(named("k2", "n2"), "k2")
    # a longer number is another word
    text = F.concat("text", F.lit(" seen by "), "n1", F.lit("; "), "n2", F.lit(", not by Customer#0000000011"), F.when(F.col("doc_id") % 11 == 0, " marked first").otherwise(""))
    phrases = people.select(F.col("c_custkey").alias("priority"), F.col("c_mktsegment").alias("label"), F.col("c_name").alias("phrase"))
    curated = read(spark, d, "labels").where("toxic = 1").select("doc_id", F.lit("hidden").alias("label"))
    return textjobs.classify(rows.select("doc_id", text.alias("text")), "doc_id", "text", [(-1, "first", "marked first$")], curated, phrases=phrases)


#: (address, subtype, name, label) of listings.
LISTED = [
    ("/AttractionProductReview-g1-d2-x.html", "", "Thermal bath", "experience"), ("/Attraction_Review-g1-d2-x.html", "Day trips", "Szentendre", "experience"), ("/Attraction_Review-g1-d2-x.html", "Museum", "City Pass office", "experience"),
    ("/Attraction_Review-g1-d2-x.html", "Museum", "House of Music", "venue"), ("/Attraction_Review-g1-d2-x.html", "", "Tourist street passage", "venue"), ("", "Cooking Class", "", "experience"), ("", "", "Guided walk", "experience"), ("", "Park", "Contour garden", "venue"),
]


@query(f"SELECT p_partkey, label, CASE label WHEN 'venue' THEN 'none' ELSE 'rule' END AS \"by\" FROM part JOIN (VALUES {', '.join(f"({i}, '{x[3]}')" for i, x in enumerate(LISTED))}) AS v(i, label) ON p_partkey % {len(LISTED)} = i")
def experience_or_venue(spark, d):
    """O-P2: the rules that tell experiences from venues, on address, subtype and name."""
    listed = spark.createDataFrame([(i, *x[:3]) for i, x in enumerate(LISTED)], "i long, url string, subtype string, name string")
    rows = read(spark, d, "part").select("p_partkey", (F.col("p_partkey") % len(LISTED)).alias("i")).join(F.broadcast(listed), "i")  # eight rows
    none = rows.select("p_partkey", F.lit("").alias("label")).limit(0)
    return textjobs.classify(rows, "p_partkey", "name", textjobs.EXPERIENCE, none, default="venue")


#: Sentences on prices under conditions, and (kind, pos, amount, currency, other, unit, scope, least, condition) of each price.
CONDITIONS = [
    ("Groups of 10 or more pay at least €15 per person. Also, groups of 20 or more: 12 EUR/adult.", [("group", 0, 15, "EUR", None, "person", "", 10, "Groups of 10 or more: minimum EUR 15.00 per person."), ("group", 1, 12, "EUR", None, "adult", "", 20, "Groups of 20 or more: minimum EUR 12.00 per adult.")]),
    ("Maximum number allowed 8 people per reservation; if you are more, we ask for £20.50 per Adult.", [("reservation", 0, 20.5, "GBP", None, "adult", "", 8, "Reservations over 8 people: GBP 20.50 per adult.")]),
    ("In winter the castle is shut\nand we give you back €5 / €6.50 at the door.", [("refund", 0, 5, "EUR", 6.5, "", "refund", None, "For a winter date: EUR 5.00 refund (also stated as EUR 6.50).")]),
    ("The booking price is the hourly rate and functions as a deposit.", [("deposit", 0, None, None, None, "hour", "deposit", None, "The displayed amount is the hourly rate and the deposit; the final cost depends on the hours.")]),
    ("Luggage in our storage boxes: $3/hour (2 hours minimum).", [("storage", 0, 3, "USD", None, "hour", "", 2, "Minimum 2 hours")]),
    ("Groups are welcome, from €15 on. Lockers are free for an hour.", []),
]
_ROWS = ", ".join("(" + ", ".join([str(i), *("NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x) for x in row)]) + ")" for i, (_, found) in enumerate(CONDITIONS) for row in found)


@query(f"SELECT doc_id, kind, pos::INTEGER AS pos, amount::DOUBLE AS amount, currency, other::DOUBLE AS other, unit, scope, least::INTEGER AS least, condition FROM documents JOIN (VALUES {_ROWS}) AS v(i, kind, pos, amount, currency, other, unit, scope, least, condition) ON doc_id % {len(CONDITIONS)} = i WHERE text IS NOT NULL")
def conditional_prices(spark, d):
    """O-X21: prices under conditions at the ends of whole documents: unit, scope, least number and the condition in words."""
    text = F.concat(F.translate("text", "$€£¥", ""), F.lit(" "), planted(CONDITIONS))
    found = textjobs.conditional_prices(read(spark, d, "documents").select("doc_id", text.alias("text")), "doc_id", "text", textjobs.PRICE_RULES)
    return found.withColumns({c: F.col(c).cast("double") for c in ("amount", "other")})


#: Frequent words of the tables' languages.
MARKERS = {
    "en": "the of and to in is that it was for with as on are this be by from at which or an were not have has but their they his her its been had would there what about when who will more all one".split(),
    "fr": "le la de et les des est que un une du en dans pour qui par sur au avec pas plus ne se ce sont cette il elle nous vous être aux ont mais comme leur ses son fait".split(),
    "de": "der die und das von den ist ein mit dem des nicht auf für im sich auch eine als es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war".split(),
    "es": "el los las que y en se con del un una por para es al lo como más su sus este pero esta son entre cuando muy sin sobre también hasta hay donde desde todo nos".split(),
}
MARKER_ROWS = [(w, k) for k, v in MARKERS.items() for w in v]


@query(r"""WITH s AS (SELECT doc_id, row_number() OVER () AS sid, sentence FROM (SELECT doc_id, trim(unnest(string_split(regexp_replace(text, '([.!?])[ \t\n\r\f\v]+', E'\\1\n', 'g'), chr(10)))) AS sentence FROM documents) WHERE sentence <> ''),
    w AS (SELECT doc_id, sid, list_filter(regexp_split_to_array(lower(sentence), '[^\p{L}]+'), lambda x: x <> '') AS ws FROM s), e AS (SELECT doc_id, sid, len(ws) AS n, unnest(ws) AS word FROM w WHERE len(ws) >= 4),
    m AS (SELECT doc_id, sid, n, lang, count(*) AS m FROM e JOIN (VALUES """ + ", ".join(f"('{w}', '{k}')" for w, k in MARKER_ROWS) + r""") AS t(word, lang) USING (word) GROUP BY 1, 2, 3, 4),
    sides AS (SELECT doc_id, sid, n, max(m) FILTER (lang <> 'en') AS f, coalesce(max(m) FILTER (lang = 'en'), 0) AS e FROM m GROUP BY 1, 2, 3), bad AS (SELECT DISTINCT doc_id FROM sides WHERE f >= 4 AND f * 3 >= n AND f > 2 * greatest(1, e))
    SELECT d.doc_id, b.doc_id IS NOT NULL AS "foreign" FROM documents d LEFT JOIN bad b USING (doc_id)""")
def language_audit(spark, d):
    """O-X10."""
    return textjobs.foreign_sentences(read(spark, d, "documents"), "doc_id", "text", MARKERS)


@query(r"""WITH w AS (SELECT 'o' AS side, item_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM benchmark UNION ALL SELECT 's', doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM documents),
    r AS (SELECT DISTINCT side, id, array_to_string(ws[i:i+19], ' ') AS run FROM w, unnest(range(1, len(ws) - 18)) AS u(i) WHERE len(ws) >= 20)
    SELECT a.id AS out_id, b.id AS src_id, count(*) AS runs FROM r a JOIN r b ON a.side = 'o' AND b.side = 's' AND a.run = b.run GROUP BY 1, 2""")
def verbatim_copy(spark, d):
    """O-X11: runs of twenty words that benchmark texts share with documents."""
    return textjobs.shared_runs(read(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text"), read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"))


@query(r"""WITH n AS (SELECT doc_id, len(list_filter(regexp_split_to_array(split_part(text, chr(10), 1), '[ \t\n\r\f\v]+'), lambda x: x <> '')) AS first, len(list_filter(string_split(text, chr(10)), lambda l: len(list_filter(regexp_split_to_array(l, '[ \t\n\r\f\v]+'), lambda x: x <> '')) >= 12)) AS strong FROM documents)
    SELECT doc_id, first < 8 AND strong < 3 AS weak, quality = 0 AS limited, first < 8 AND strong < 3 AND coalesce(quality, 1) = 1 AS issue FROM n LEFT JOIN labels USING (doc_id)""")
def evidence_strength(spark, d):
    """O-X12: a short description and few long reviews are weak evidence, which must be marked; the lines of a text stand
    for its reviews."""
    weak = textjobs.weak_evidence(F.get(F.split("text", "\n"), F.lit(0)), F.split("text", "\n"))
    n = read(spark, d, "documents").select("doc_id", weak.alias("weak"))
    return n.join(read(spark, d, "labels"), "doc_id", "left").select("doc_id", "weak", (F.col("quality") == 0).alias("limited"), (F.col("weak") & (F.coalesce("quality", F.lit(1)) == 1)).alias("issue"))


@query(r"""WITH r AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, text[length(split_part(text, chr(10), 1)) + 2:] AS body FROM documents)
    SELECT doc_id, CASE WHEN moved THEN '' ELSE title END AS title, md5(CASE WHEN moved THEN title ELSE body END) AS body, moved FROM (SELECT *, trim(body) = '' AND (length(title) > 120 OR len(string_split(trim(title), ' ')) >= 20) AS moved FROM r)""")
def body_repair(spark, d):
    """O-X13: a body that stands in the title moves back."""
    title = F.substring_index("text", "\n", 1)
    r = read(spark, d, "documents").select("doc_id", title.alias("title"), F.expr("substring(text, length(substring_index(text, '\\n', 1)) + 2)").alias("body"))
    return textjobs.body_repair(r, "title", "body").select("doc_id", "title", F.md5("body").alias("body"), "moved")


@query(r"""SELECT doc_id, code FROM (SELECT doc_id, 'text-incomplete' AS code FROM documents WHERE NOT regexp_matches(rtrim(text), '[.!?]["''”’)]*$') UNION ALL SELECT doc_id, 'text-script' FROM documents WHERE regexp_matches(text, '[\x{0370}-\x{052f}\x{0600}-\x{06ff}\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{ac00}-\x{d7af}]')
    UNION ALL SELECT doc_id, 'text-too-long' FROM documents WHERE length(text) > 4000)""")
def prose_audit(spark, d):
    """O-X20."""
    return textjobs.prose_issues(read(spark, d, "documents"), "doc_id", {"text": 4000})


@query("""SELECT p_partkey, coalesce(fixed, p_name) AS name, fixed IS NOT NULL AS repaired FROM part LEFT JOIN (SELECT s_suppkey, upper(s_name) AS fixed FROM supplier WHERE s_suppkey % 3 = 0) ON s_suppkey = p_partkey""")
def title_repair(spark, d):
    """O-P4: overrides by identity, never by title."""
    fixed = read(spark, d, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("p_partkey"), F.upper("s_name").alias("p_name"))
    return inventory.repaired_names(read(spark, d, "part"), fixed, "p_partkey", "p_name").select("p_partkey", F.col("p_name").alias("name"), "repaired")
