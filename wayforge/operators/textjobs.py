"""Whole-table text jobs: language markers, copies, sentences, audits."""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayforge.functions import text as T


def issues(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, code): one row for each rule that holds; null is not held."""
    found = F.array_compact(F.array(*(F.when(F.coalesce(t, F.lit(False)), F.lit(c)) for c, t in rules.items())))
    return df.select(key, F.explode(found).alias("code"))


def mentions(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, token, currency, amount): each money token of a text."""
    rows = df.select(key, F.posexplode(T.money_mentions(F.col(text))).alias("pos", "token"))
    return rows.withColumns({"currency": T.currency(F.col("token")), "amount": T.amount(F.col("token"))})


def sentence_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, F.posexplode(T.sentences(F.col(text))).alias("pos", "sentence"))


def words(c: Column) -> Column:
    """Words of a text: runs of letters, in small letters."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: w != "")


def foreign_sentences(df: DataFrame, key: str, text: str, markers: dict[str, list[str]], home: str = "en", least_words: int = 4, least_markers: int = 4) -> DataFrame:
    """(key, foreign): whether some sentence of at least four words is written in another language than the home one:
    enough of its words are markers of that language, a third of all, and over twice those of the home language.

    Markers are counted in place, sentence by sentence, so nothing is shuffled."""
    held = lambda w, lang: F.size(F.filter(w, lambda x: x.isin(*markers[lang])))
    others = [k for k in markers if k != home]

    def bad(sentence: Column) -> Column:
        w = words(sentence)
        most = F.greatest(*(held(w, k) for k in others), F.lit(0))
        return (F.size(w) >= least_words) & (most >= least_markers) & (most * 3 >= F.size(w)) & (most > 2 * F.greatest(F.lit(1), held(w, home)))

    return df.select(key, F.coalesce(F.exists(T.sentences(F.col(text)), bad), F.lit(False)).alias("foreign"))


#: Bits of the filter of runs: it stands beside every text while its runs are sifted, so it has 32 KB. With over half a
#: million runs of outputs it lets most pass and saves little; what passes is always joined exactly.
RUN_BITS = 1 << 18


def run_filter(runs: DataFrame, bits: int = RUN_BITS) -> DataFrame:
    """One row (_bits): a bitmap of the hashes of runs (h), of a size that does not depend on them."""
    at = F.pmod(F.col("h"), F.lit(bits))
    words = runs.groupBy(F.floor(at / 64).cast("int").alias("_word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(h, {bits}) % 64 as int))")).alias("_b"))
    every = words.union(runs.sparkSession.range(bits // 64).select(F.col("id").cast("int"), F.lit(0).cast("long")))
    every = every.groupBy("_word").agg(F.max(F.struct(F.col("_b") != 0, "_b")).alias("_b"))  # the word, or 0 where there is none
    return every.agg(F.array_sort(F.collect_list(F.struct("_word", F.col("_b._b").alias("b")))).alias("_w")).select(F.transform("_w", lambda x: x["b"]).alias("_bits"))  # bits / 64 entries


def shared_runs(outputs: DataFrame, sources: DataFrame, width: int = 20) -> DataFrame:
    """(out_id, src_id, runs): distinct runs of ``width`` words that an output shares with a source.

    Both have id and text. A text's runs are hashed in place, each distinct one once; of the sources only those runs are made
    rows that a bitmap of the outputs' runs lets pass. Hits meet by hash and are gathered by pair of texts, which are then
    compared word by word once, so texts are shuffled once a pair and runs never."""

    words = lambda c: F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda x: x != "")

    def runs(df, name):
        # words as hashes, made once for a text: bound as the element of a list
        hashed = F.array(F.transform(words(F.col("text")), lambda x: F.xxhash64(x)))
        places = lambda h: F.sequence(F.lit(1), F.greatest(F.size(h) - width + 1, F.lit(1)))
        grams = F.transform(hashed, lambda h: F.when(F.size(h) >= width, F.transform(places(h), lambda i: F.struct(F.xxhash64(F.slice(h, i, width)).alias("h"), i.alias("at")))))
        return df.select(F.col("id").alias(name), grams[0].alias("grams"))

    a, b = runs(outputs, "out_id"), runs(sources, "src_id")
    # an outer explode: from a plain one a filter would be inferred that makes the words anew for each run
    flat = lambda df, name: df.select(name, F.explode_outer("grams").alias("g")).where("g is not null").groupBy(name, "g.h").agg(F.min("g.at").alias("at"))
    wanted = flat(a, "out_id")
    passing = b.crossJoin(F.broadcast(run_filter(wanted)))  # one row of a fixed size
    some = passing.select("src_id", F.filter("grams", _passes).alias("grams"))
    hits = wanted.join(flat(some, "src_id").withColumnRenamed("at", "src_at"), "h")
    pairs = hits.groupBy("out_id", "src_id").agg(F.collect_list(F.struct("at", "src_at")).alias("_hits"))  # distinct runs of one output
    text = lambda df, name, c: df.select(F.col("id").alias(name), F.col("text").alias(c))
    both = pairs.join(text(outputs, "out_id", "_a"), "out_id").join(text(sources, "src_id", "_b"), "src_id")
    sides = F.array(F.struct(words(F.col("_a")).alias("a"), words(F.col("_b")).alias("b")))
    same = F.transform(sides, lambda s: F.size(F.filter("_hits", lambda x: F.slice(s["a"], x["at"], width) == F.slice(s["b"], x["src_at"], width))))[0]
    return both.select("out_id", "src_id", same.cast("long").alias("runs")).where("runs > 0")


def _passes(gram: Column) -> Column:
    """Whether the bitmap _bits has a gram's hash."""
    at = F.pmod(gram["h"], F.lit(RUN_BITS))
    return F.getbit(F.get("_bits", F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1


def surcharges(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, amount, unit, sentence): each money token in a sentence on additional charges, once."""
    rows = df.select(key, F.explode(T.sentences(F.col(text), ".;!?")).alias("sentence")).where(F.col("sentence").rlike(T.ADDITIONAL))
    rows = rows.select(key, F.explode(T.money_mentions(F.col("sentence"))).alias("amount"), T.charge_unit(F.col("sentence")).alias("unit"), "sentence")
    same = F.struct(F.lower("amount"), "unit", F.lower("sentence"))
    return rows.groupBy(key, same.alias("_same")).agg(F.min("amount").alias("amount"), F.first("unit").alias("unit"), F.min("sentence").alias("sentence")).drop("_same")


#: Rules in one condition of a plan, and bytes of phrases in one automaton.
CONDITION_RULES, AUTOMATON_BYTES = 500, 64 << 20


def matched_rule(rules: list[tuple]) -> Column:
    """(priority, label) of the first rule that matches; rules: (priority, label, pattern, column).

    Rules are tried in order of priority until one matches; each column is a text of the row."""
    rules = sorted(rules, key=lambda r: (r[0], r[1]))
    parts = []
    for i in range(0, len(rules), CONDITION_RULES):
        cases = None
        for priority, label, pattern, column in rules[i : i + CONDITION_RULES]:
            hit, found = F.col(column).rlike(pattern), F.struct(F.lit(priority).cast("long").alias("priority"), F.lit(label).alias("label"))
            cases = F.when(hit, found) if cases is None else cases.when(hit, found)
        parts.append(cases)
    return F.coalesce(*parts, F.lit(None).cast("struct<priority:bigint,label:string>"))


def _automaton(phrases: pa.ChunkedArray) -> tuple:
    """An automaton that knows phrases by their places, and the length of each; a Python object for each phrase's rule
    would take several times as much."""
    import ahocorasick

    automaton, sizes = ahocorasick.Automaton(ahocorasick.STORE_INTS), array("i")
    for i in range(0, len(phrases), 10_000):
        for phrase in phrases.slice(i, 10_000).to_pylist():
            automaton.add_word(phrase, len(sizes))
            sizes.append(len(phrase))
    automaton.make_automaton()
    return automaton, sizes


def matched_phrases(df: DataFrame, text: str, rules: DataFrame, name: str = "_phrase") -> DataFrame:
    """df with ``name``: (priority, label) of the first rule, by priority and label, whose phrase stands in the text, or null.

    rules: (priority long, label, phrase). Phrases are literal, letters of either case, and begin and end where words do. All
    phrases are found in one pass over a text by an automaton. Rules are taken in parts of AUTOMATON_BYTES, so what is
    collected and broadcast is bounded however many there are; each further part is one more pass. Empty phrases match
    nothing; a null text has no rule."""
    spark = df.sparkSession
    rules = rules.select(F.col("priority").cast("long"), "label", F.lower("phrase").alias("phrase")).where("phrase <> ''")
    size = rules.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    parts = size // AUTOMATON_BYTES + 1
    kind = pa.struct([("priority", pa.int64()), ("label", pa.string())])
    at = df.columns.index(text)
    out = df.withColumn(name, F.lit(None).cast("struct<priority:bigint,label:string>"))
    schema = out.schema
    for part in range(parts):
        own = rules.where(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == part).groupBy("phrase").agg(F.min(F.struct("priority", "label")).alias("r"))
        rows = own.select("phrase", "r.priority", "r.label").toArrow().sort_by([("priority", "ascending"), ("label", "ascending")])
        held = spark.sparkContext.broadcast(rows.set_column(2, "label", rows["label"].dictionary_encode()).combine_chunks())

        def run(batches, held=held):
            automaton, sizes = _automaton(held.value["phrase"])
            priorities, labels = held.value["priority"], held.value["label"]

            def first(value: str | None, best):
                if not value or not len(automaton):
                    return best
                value, place = value.lower(), None
                for end, at_rule in automaton.iter(value):
                    start = end - sizes[at_rule] + 1
                    inside = (start > 0 and value[start - 1].isalnum() and value[start].isalnum()) or (value[end].isalnum() and value[end + 1 : end + 2].isalnum())
                    if not inside and (place is None or at_rule < place):
                        place = at_rule
                found = None if place is None else (priorities[place].as_py(), labels[place].as_py())
                return found if best is None or (found is not None and found < best) else best

            for batch in batches:
                old = [x and (x["priority"], x["label"]) for x in batch.column(batch.num_columns - 1).to_pylist()]
                found = [first(x, b) for x, b in zip(batch.column(at).to_pylist(), old)]
                rows = [None if x is None else {"priority": x[0], "label": x[1]} for x in found]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, kind)], schema.names)

        out = out.mapInArrow(run, schema)
    return out


def classify(df: DataFrame, key: str, text: str, rules: list[tuple], curated: DataFrame, default: str = "review", phrases: DataFrame | None = None) -> DataFrame:
    """(key, label, by): the first rule by priority that matches; curated keys (key, label) win, and rows without any have the
    default label.

    rules: (priority, label, pattern) on the text, or (priority, label, pattern, column) on another column; ``phrases``: a
    table of literal rules (priority, label, phrase) of any size on the text. Of rules of equal priority the first label counts."""
    some = matched_phrases(df, text, phrases) if phrases is not None else df.withColumn("_phrase", F.lit(None).cast("struct<priority:bigint,label:string>"))
    rule = F.array_min(F.array(matched_rule([r if len(r) > 3 else (*r, text) for r in rules]), F.col("_phrase")))["label"]
    c = curated.select(key, F.col("label").alias("_curated"))
    out = some.select(key, rule.alias("_rule")).join(c, key, "left")
    by = F.when(F.col("_curated").isNotNull(), "curated").when(F.col("_rule").isNotNull(), "rule").otherwise("none")
    return out.select(key, F.coalesce("_curated", "_rule", F.lit(default)).alias("label"), by.alias("by"))


#: Wording of what is sold as an experience; all else is a venue.
PRODUCT_LINK, TOUR_KIND = "AttractionProductReview", "(?i)tour|cruise|crawl|safari|sightseeing|day trip|transfer|lesson|workshop|class"
TOUR_NAME = r"(?i)\btour\b|\bcrawl\b|\bcruise\b|\bexperience\b|\btasting\b|\bclass\b|transfer|sightseeing|guided|\bticket\b|admission|\bpass\b"
EXPERIENCE = [(1, "experience", PRODUCT_LINK, "url"), (2, "experience", TOUR_KIND, "subtype"), (3, "experience", TOUR_NAME, "name")]


@dataclass(frozen=True)
class PriceRule:
    """How a text states a price under a condition: a pattern and the numbers of its groups for the amount and, if it has them,
    another amount, the least number and the unit; a unit and scope that hold for all; the condition in words, in which
    {amount}, {other}, {least} and {unit} stand for what was found. Without an amount the rule only states unit and scope."""

    kind: str
    pattern: str
    condition: str
    amount: int = 0
    other: int = 0
    least: int = 0
    unit_group: int = 0
    unit: str = ""
    scope: str = ""


_MONEY = T.MONEY.removeprefix("(?i)")
#: Wording of charges for larger parties, refunds of parts, hourly rates that are deposits, storage by the hour.
PRICE_RULES = [
    PriceRule("group", rf"(?is)\bgroups?\s+of\s+(\d+)\s+or\s+more\b.{{0,280}}?{_MONEY}\s*(?:/|\bper\b)\s*(person|adult)\b", "Groups of {least} or more: minimum {amount} per {unit}.", 2, least=1, unit_group=3),
    PriceRule("reservation", rf"(?is)\bmaximum\s+(?:(?:number|group)\s+)?(?:allowed\s+)?(\d+)\s+people\s+per\s+reservation\b.{{0,180}}?\bif\s+you\s+are\s+more\b.{{0,80}}?{_MONEY}\s*(?:/|\bper\b)\s*(adult|person)\b", "Reservations over {least} people: {amount} per {unit}.", 2, least=1, unit_group=3),
    PriceRule("refund", rf"(?is)\bin\s+winter\b.{{0,420}}?\b(?:refund|return|give\s+you\s+back)\b\s*{_MONEY}\s*/\s*{_MONEY}", "For a winter date: {amount} refund (also stated as {other}).", 1, other=2, scope="refund"),
    PriceRule("deposit", r"(?i)\bthe\s+booking\s+price\s+is\s+the\s+hourly\s+rate\s+and\s+functions?\s+as\s+a\s+deposit\b", "The displayed amount is the hourly rate and the deposit; the final cost depends on the hours.", unit="hour", scope="deposit"),
    PriceRule("storage", rf"(?is)\b(?:luggage|storage\s+boxes?|lockers?)\b.{{0,220}}?{_MONEY}\s*/\s*hour\b.{{0,100}}?\(?(\d+)\s+hours?\s+min(?:imum)?\b", "Minimum {least} hours", 1, least=2, unit="hour"),
]


def conditional_prices(df: DataFrame, key: str, text: str, rules: list[PriceRule]) -> DataFrame:
    """(key, kind, pos, amount, currency, other, unit, scope, least, condition): every place where a rule's wording stands, from 0
    in each rule; amounts without a number are left out. Texts are squeezed first."""
    df = df.select(key, T.squeezed(F.col(text)).alias("_t"))
    places = lambda n, r: F.transform(F.regexp_extract_all("_t", F.lit(r.pattern), 0), lambda t, i: F.struct(F.lit(n).alias("rule"), i.alias("pos"), t.alias("whole")))
    # one search of a text a rule; what a place says is read off the place's own text, in steps that are made once
    rows = df.select(key, F.explode(F.flatten(F.array(*(places(n, r) for n, r in enumerate(rules))))).alias("_r")).select(key, "_r.*")

    def by_rule(value) -> Column:
        return F.coalesce(*(F.when(F.col("rule") == n, value(r)) for n, r in enumerate(rules)))

    group = lambda n, r: F.regexp_extract("whole", r.pattern, n) if n else F.lit(None).cast("string")
    texts = {"_money": lambda r: group(r.amount, r), "_other": lambda r: group(r.other, r), "_least": lambda r: group(r.least, r), "unit": lambda r: F.lower(group(r.unit_group, r)) if r.unit_group else F.lit(r.unit)}
    rows = rows.select(key, "rule", "pos", F.explode(F.array(F.struct(*(by_rule(f).alias(c) for c, f in texts.items())))).alias("_g")).select(key, "rule", "pos", "_g.*")
    money = {f"{c}{of}": F.col(f) for of, f in (("", "_money"), ("_other", "_other")) for c in ("amount", "currency")}
    money = {c: (T.amount if c.startswith("amount") else T.currency)(f) for c, f in money.items()}
    rows = rows.withColumns(money).where("amount is not null or _money is null")

    def words(r: PriceRule) -> Column:
        label = lambda of: F.concat_ws(" ", F.col(f"currency{of}"), F.col(f"amount{of}").cast("string"))
        out = F.lit(r.condition)
        for name, value in (("amount", label("")), ("other", label("_other")), ("least", F.coalesce("_least", F.lit(""))), ("unit", F.col("unit"))):
            out = F.replace(out, F.lit("{" + name + "}"), value) if "{" + name + "}" in r.condition else out
        return out

    return rows.select(key, by_rule(lambda r: F.lit(r.kind)).alias("kind"), "pos", "amount", "currency", F.col("amount_other").alias("other"), "unit", by_rule(lambda r: F.lit(r.scope)).alias("scope"), F.col("_least").try_cast("int").alias("least"), by_rule(words).alias("condition"))


def weak_evidence(description: Column, reviews: Column, least_words: int = 8, least_reviews: int = 3, review_words: int = 12) -> Column:
    """Whether a short description and too few long reviews (array of texts) are all there is."""
    count = lambda c: F.size(F.filter(F.split(c, r"[ \t\n\x0B\f\r]+"), lambda x: x != ""))
    return (count(description) < least_words) & (F.size(F.filter(reviews, lambda x: count(x) >= review_words)) < least_reviews)


def body_repair(df: DataFrame, title: str, text: str, most_chars: int = 120, most_words: int = 20) -> DataFrame:
    """df with ``moved``: a body that stands in the title, as the text is empty and the title too long, moves to the text."""
    moved = (F.trim(F.col(text)) == "") & ((F.length(title) > most_chars) | (F.size(F.split(F.trim(F.col(title)), " ")) >= most_words))
    return df.withColumn("moved", moved).withColumns({title: F.when(moved, "").otherwise(F.col(title)), text: F.when(moved, F.col(title)).otherwise(F.col(text))})


#: The longest that each field of a brief may be.
CAPS = {"what": 320, "do": 320, "why": 420, "summary": 240}
#: Scripts that published text must not have.
WRONG_SCRIPT = r"[\u0370-\u052f\u0600-\u06ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]"


def prose_issues(df: DataFrame, key: str, fields: dict[str, int]) -> DataFrame:
    """(key, code): of each field of text, with its longest length: incomplete, script or too-long."""
    rules = {}
    for f, most in fields.items():
        c = F.col(f)
        rules |= {f"{f}-incomplete": ~F.rtrim(c).rlike(r"[.!?][\"'”’)]*\z"), f"{f}-script": c.rlike(WRONG_SCRIPT), f"{f}-too-long": F.length(c) > most}
    return issues(df, key, rules)


#: Control characters, surrogates, replacement and interlinear marks that a text must not have.
def hygiene_rules(c: Column) -> dict[str, Column]:
    return {
        "text-control": c.rlike(r"[\x00-\x08\x0B-\x1F\x7F-\x9F]"),
        "text-replacement": F.contains(c, F.lit("\ufffd")) | c.rlike(r"[\x{D800}-\x{DFFF}]"),
        "text-interlinear": c.rlike(r"[\x{FFF9}-\x{FFFB}]"),
        "text-nfc": ~T.is_nfc(c),
        "text-space": c.rlike(r"[ \u00a0]{2}|^\s|\s\z"),
    }
