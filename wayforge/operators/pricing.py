"""Prices: reconciliation of charges, floors, starting prices, states and availability of packages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayforge.session import work_path

#: Currencies without small coins, whose sums may be off by one.
WHOLE_CURRENCIES = ("HUF", "JPY")
NEGATIVE_RANK = {"closed": 1, "sold-out": 2, "unavailable": 3}


def charge_issues(charges: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """(key, code): charges (currency, n, unit_price decimal) against the total (total decimal) within the tolerance."""
    per = charges.groupBy(key).agg(F.sum(F.col("n") * F.col("unit_price")).alias("_sum"), F.count("*").alias("_lines"), F.min("currency").alias("_c"), F.max("currency").alias("_d"))
    tolerance = F.when(F.col("_c").isin(*WHOLE_CURRENCIES), F.lit(1).cast("decimal(18,2)")).otherwise(F.greatest(F.lit("0.05").cast("decimal(18,2)"), (F.col("_lines") * F.lit("0.02").cast("decimal(18,2)")).cast("decimal(18,2)")))
    code = F.when(F.col("_c") != F.col("_d"), "mixed-currency").when(F.abs(F.col("_sum") - F.col("total")) > tolerance, "price-math")
    return per.join(totals, key).select(key, code.alias("code")).where("code is not null")


def exact_line_issues(lines: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """(key, total, summed) where the lines (n, price decimal) do not add up to the total exactly."""
    summed = lines.groupBy(key).agg(F.sum(F.col("n") * F.col("price")).alias("summed"))
    return totals.join(summed, key).where(F.col("summed") != F.col("total")).select(key, "total", "summed")


def price_floor(packages: DataFrame, key: str) -> DataFrame:
    """(key, outcome, floor): packages (kind numeric, free or date; amount, currency, unit, scope, availability).

    Sold-out and unavailable ones are no options; a floor uses the surely available ones if there are any, and only
    where currency, unit and scope are all the same."""
    options = packages.where("availability not in ('sold-out', 'unavailable') or availability is null")
    numeric, sure = F.col("kind") == "numeric", F.col("availability") == "available"
    what = F.concat_ws("|", "currency", "unit", "scope")
    side = lambda test: (F.min(F.when(test, F.col("amount"))), F.min(F.when(test, what)), F.max(F.when(test, what)))
    named = [c.alias(f"_{p}{i}") for p, test in (("s", numeric & sure), ("n", numeric)) for i, c in enumerate(side(test))]
    agg = options.groupBy(key).agg(F.count("*").alias("_n"), F.count_if(F.col("kind") == "free").alias("_free"), F.count_if(numeric).alias("_numeric"), *named)
    every = packages.select(key).distinct().join(agg, key, "left")
    low, a, b = (F.when(F.col("_s0").isNotNull(), F.col(f"_s{i}")).otherwise(F.col(f"_n{i}")) for i in range(3))
    outcome = (
        F.when(F.col("_n").isNull(), "No selectable options").when((F.col("_free") > 0) & (F.col("_numeric") > 0), "Free and paid options")
        .when((F.col("_free") > 0) & (F.col("_free") < F.col("_n")), "Free and date-dependent options").when(F.col("_free") > 0, "Free")
        .when((F.col("_numeric") == 0) | (a != b), "Prices vary").otherwise("From")
    )
    return every.select(key, outcome.alias("outcome"), low.alias("floor")).withColumn("floor", F.when(F.col("outcome") == "From", F.col("floor")))


def starting_price(bases: DataFrame, packages: DataFrame, key: str) -> DataFrame:
    """(key, amount, unit, scope): the base (base, currency, scope), or a cheaper comparable package.

    Comparable are the available numeric packages of the base's currency, if all have one unit that is neither empty nor
    a group's; the cheapest brings its unit and its scope. If all numeric packages share a scope, that is the price's."""
    numeric = packages.where("kind = 'numeric'").join(bases.select(key, F.col("currency").alias("_c")), key)
    fit = (F.col("availability") == "available") & (F.col("currency") == F.col("_c"))
    unit, scope = F.coalesce("unit", F.lit("")), F.coalesce("scope", F.lit(""))
    best = numeric.groupBy(key).agg(
        F.min(F.when(fit, F.struct("amount", unit.alias("unit"), scope.alias("scope")))).alias("_best"), F.min(F.when(fit, unit)).alias("_u"), F.max(F.when(fit, unit)).alias("_v"), F.min(scope).alias("_s"), F.max(scope).alias("_t"),
    )
    out = bases.join(best, key, "left")
    better = F.coalesce((F.col("_u") == F.col("_v")) & ~F.col("_u").isin("", "group") & (F.col("_best.amount") < F.col("base")), F.lit(False))
    common = F.when((F.col("_s") == F.col("_t")) & (F.col("_s") != ""), F.col("_s"))
    own = F.when(better & (F.col("_best.scope") != ""), F.col("_best.scope")).otherwise(F.col("scope"))
    return out.select(key, F.when(better, F.col("_best.amount")).otherwise(F.col("base")).alias("amount"), F.when(better, F.col("_u")).otherwise("").alias("unit"), F.coalesce(common, own, F.lit("")).alias("scope"))


#: Where a page states its availability, in the order in which the places are tried.
SCOPES = ("banner", "no-commerce", "top-commerce", "right-rail", "call-to-action", "title")


def availability_rollup(messages: DataFrame, packages: DataFrame, key: str) -> DataFrame:
    """(key, availability, source): of the stated messages (key, scope, text) and the packages (key, availability).

    A negative message wins by rank, then by place; then what the packages agree on; then a call to book; then a message
    that asks for a date; else unknown."""
    from wayforge.functions import text as T

    place = F.array_position(F.array(*map(F.lit, SCOPES)), F.col("scope"))
    state = T.availability(F.col("text"))
    rank = F.coalesce(*(F.when(state == s, r) for s, r in NEGATIVE_RANK.items()))
    said = messages.select(key, place.alias("_place"), "scope", state.alias("_state"), rank.alias("_rank"), ((F.col("scope") == "call-to-action") & F.col("text").rlike(r"(?i)\b(?:reserve|book)\s+now\b")).alias("_book"))
    m = said.groupBy(key).agg(
        F.min(F.when(F.col("_rank").isNotNull(), F.struct("_rank", "_place", "_state", "scope"))).alias("_neg"), F.coalesce(F.bool_or("_book"), F.lit(False)).alias("_cta"), F.min(F.when(F.col("_state") == "date-required", F.struct("_place", "scope"))).alias("_date"),
    )
    have = lambda s: F.coalesce(F.bool_or(F.col("availability") == s), F.lit(False))
    p = packages.groupBy(key).agg(have("available").alias("_any"), F.coalesce(F.bool_and(F.coalesce(F.col("availability") == "sold-out", F.lit(False))), F.lit(False)).alias("_out"), F.bool_and(F.coalesce(F.col("availability").isin(*NEGATIVE_RANK), F.lit(False))).alias("_all"))
    out = m.join(p, key, "full_outer")
    pick = lambda neg, some, none, all_, cta, date: (
        F.when(F.col("_neg").isNotNull(), neg).when(F.col("_any"), some).when(F.col("_out"), none).when(F.col("_all"), all_).when(F.col("_cta"), cta).when(F.col("_date").isNotNull(), date)
    )
    packages_ = F.lit("packages")
    return out.select(
        key, F.coalesce(pick(F.col("_neg._state"), F.lit("available"), F.lit("sold-out"), F.lit("unavailable"), F.lit("available"), F.lit("date-required")), F.lit("unknown")).alias("availability"),
        F.coalesce(pick(F.col("_neg.scope"), packages_, packages_, packages_, F.lit("call-to-action"), F.col("_date.scope")), F.lit("")).alias("source"),
    )


#: Reasons, sources and wording of a failed lookup of packages.
LOOKUP_REASONS = ("pax_failed", "tour_grades_failed", "package_options_failed", "package_options_unavailable")
LOOKUP_SOURCE = r"^graphql:(?:paxmix|tourgrades)"
LOOKUP_MESSAGE = r"(?is)\b(?:package|travell?er)\b.{0,80}\b(?:lookup|option|availability|mix)\b.{0,80}\b(?:failed|unavailable|not returned|no packages?)\b"


def lookup_failed() -> Column:
    """Whether the lookup of packages failed, which is not a closed activity: from availability, reason, source, message, status."""
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    why = low("reason").isin(*LOOKUP_REASONS) | low("source").rlike(LOOKUP_SOURCE) | F.coalesce(F.col("message"), F.lit("")).rlike(LOOKUP_MESSAGE) | (low("status") == "priced")
    return low("availability").isin("unknown", "unavailable") & why


def normal_packages(packages: DataFrame) -> DataFrame:
    """packages (availability, unit_price, total_price, unit) with amount, unit and kind: the unit price, else the total as
    a group's price; without any, the price depends on the date. Availability is one of available, sold-out, unavailable
    and date-required."""
    amount = F.coalesce("unit_price", "total_price")
    low = F.lower(F.trim(F.coalesce("availability", F.lit(""))))
    state = F.when(low == "sold-out", "sold-out").when(low.isin("closed", "unavailable"), "unavailable").when(low == "available", "available").when(amount.isNotNull(), "available").otherwise("date-required")
    return packages.withColumns({"amount": amount, "kind": F.when(amount.isNotNull(), "exact").otherwise("date-required"), "unit": F.when(F.col("unit_price").isNotNull(), F.col("unit")).when(amount.isNotNull(), "group"), "availability": state})


def price_states(facts: DataFrame, packages: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(states, packages): the state of each key's price, and its packages as that state leaves them.

    facts: (key, base, status, availability, reason, source, message, is_product, free). packages as normal_packages
    takes them, with ord and name. states: (key, state, base, failed). Zero is no price. In turn: unavailable unless the
    lookup failed; priced by a base, or by a package with a number unless the lookup failed; date-required if it failed;
    an explicit free, date-required or not-published; date-required for products; free by evidence; not-published.
    Free evidence puts a general admission first; a state that is not published has no packages; if unavailable, no
    package is available. The states lie in the shared folder until session.clear_work is called."""
    normal = normal_packages(packages)
    numbers = normal.groupBy(key).agg(F.bool_or(F.col("kind") == "exact").alias("_numeric"))
    base, status = F.when(F.col("base") > 0, F.col("base")), F.lower(F.trim(F.coalesce("status", F.lit(""))))
    failed, free = lookup_failed(), (status == "free") | (~F.col("is_product") & F.col("free"))
    state = (
        F.when((status == "unavailable") & ~failed, "unavailable").when(base.isNotNull() | (F.coalesce("_numeric", F.lit(False)) & ~failed), "priced").when(failed, "date-required")
        .when(status.isin("free", "date-required", "not-published"), status).when(F.col("is_product"), "date-required").when(free, "free").otherwise("not-published")
    )
    states = facts.join(numbers, key, "left").select(key, state.alias("state"), base.alias("base"), failed.alias("failed"), free.alias("_free"))
    # written once: states go into the packages, the admissions and the result, and three copies of their joins in one task hold three times the memory
    path = work_path(facts.sparkSession, "price-states")
    states.write.parquet(path)
    states = facts.sparkSession.read.schema(states.schema).parquet(path)
    shown = normal.join(states.select(key, "state"), key).where("state <> 'not-published'")
    shown = shown.withColumn("availability", F.when((F.col("state") == "unavailable") & ~F.col("availability").isin("sold-out", "unavailable"), "unavailable").otherwise(F.col("availability")))
    admission = states.where("_free and state <> 'unavailable'").select(key, F.lit(-1).cast("long").alias("ord"), F.lit("General admission").alias("name"), F.lit("available").alias("availability"), F.lit("free").alias("kind"), F.lit(None).cast("decimal(18,2)").alias("amount"), F.lit(None).cast("string").alias("unit"))
    shown = shown.select(key, F.col("ord").cast("long").alias("ord"), "name", "availability", "kind", F.col("amount").cast("decimal(18,2)").alias("amount"), "unit").unionByName(admission)
    return states.drop("_free"), shown


#: Names under which evidence gives an amount, in the order in which they are tried.
AMOUNT_NAMES = ("amount", "value", "total", "price", "totalPrice", "displayPrice", "pricing")


#: What an object of evidence may hold of a price, and what the objects inside of it may.
_LEVEL = f"struct<{', '.join(f'{x}: decimal(18,2)' for x in AMOUNT_NAMES)}, currency: string, currencyCode: string>"
_INNER = f"struct<{', '.join(f'{x}: {_LEVEL}' for x in AMOUNT_NAMES)}>"


def price_parts(prices: Column, fallback: Column) -> Column:
    """Of an array of prices given as VARIANTs an array of structs (amount, currency): of a number, or of an object with one
    under the first of the names that has one, itself or an object's; the currency is the inner object's, else the outer
    one's, else the fallback. Null for a price without an amount.

    A price is cast once to each of its levels, not searched once for each path."""
    code = lambda x: F.coalesce(x["currency"], x["currencyCode"])
    part = lambda amount, *currency: F.when(amount.isNotNull(), F.struct(amount.alias("amount"), F.upper(F.coalesce(*currency)).alias("currency")))
    level = lambda v, kind: F.try_variant_get(v, "$", kind)
    cast = F.transform(prices, lambda v: F.struct(level(v, "decimal(18,2)").alias("number"), level(v, _LEVEL).alias("own"), level(v, _INNER).alias("inner")))

    def first(p: Column) -> Column:
        found, own = [part(p["number"], fallback)], p["own"]
        for x in AMOUNT_NAMES:
            inner = p["inner"][x]
            found += [part(own[x], code(own), fallback), F.when(inner.isNotNull(), part(F.coalesce(*(inner[y] for y in AMOUNT_NAMES)), code(inner), code(own), fallback))]
        return F.coalesce(*found)

    return F.transform(cast, first)


EVIDENCE = "travelDate string, calendar array<struct<date: string, price: variant>>, grades array<struct<title: string, status: string, price: variant, totalPrice: variant, pricing: variant>>"


def price_projection(documents: DataFrame, key: str, document: str) -> tuple[DataFrame, DataFrame]:
    """(prices, packages) of evidence documents in JSON (EVIDENCE).

    prices: (key, base, currency, packages, state), a row for each document: the base price of the chosen date's calendar
    row; state is date-required without a date, unknown without packages, else unavailable, free (all amounts zero),
    not-published (no amount) or available. packages: (key, at, title, amount, currency, availability), the currency
    inherited from the base. A document's packages are judged inside of its row, so nothing is shuffled."""
    e = documents.select(key, F.from_json(document, EVIDENCE).alias("e")).select(key, "e.*")
    row = F.get(F.filter("calendar", lambda r: r["date"] == F.col("travelDate")), F.lit(0))
    e = e.select(key, "travelDate", F.get(price_parts(F.array(row["price"]), F.lit("USD")), F.lit(0)).alias("_p"), "grades")
    e = e.select(key, "travelDate", F.col("_p.amount").alias("base"), F.coalesce("_p.currency", F.lit("USD")).alias("base_currency"), "grades")
    parts = price_parts(F.transform("grades", lambda g: F.coalesce(g["price"], g["totalPrice"], g["pricing"])), F.col("base_currency"))

    def state(g: Column) -> Column:
        text = F.coalesce(g["status"], F.lit(""))
        return F.when(text.rlike("(?i)sold[ -]?out"), "sold-out").when(text.rlike("(?i)unavailable|not available|failed"), "unavailable").when(text.rlike("(?i)closed"), "closed").otherwise("available")

    count, most = F.when(F.col("grades").isNull(), 0).otherwise(F.size("grades")).cast("long"), F.array_max(F.transform(parts, lambda p: p["amount"]))
    out = e.select(key, "travelDate", "base", "base_currency", count.alias("packages"), F.forall("grades", lambda g: state(g) != "available").alias("_neg"), most.alias("_most"))
    overall = F.when(F.col("travelDate").isNull(), "date-required").when(F.col("packages") == 0, "unknown").when(F.col("_neg"), "unavailable").when(F.col("_most") == 0, "free").when(F.col("_most").isNull(), "not-published").otherwise("available")
    prices = out.select(key, "base", F.when(F.col("base").isNotNull(), F.col("base_currency")).alias("currency"), "packages", overall.alias("state"))
    package = F.zip_with("grades", parts, lambda g, p: F.struct(g["title"].alias("title"), p["amount"].alias("amount"), p["currency"].alias("currency"), state(g).alias("availability")))
    return prices, e.select(key, F.posexplode(package).alias("at", "g")).select(key, "at", "g.*")


#: States of availability, the negative ones, and what a price's status is for each.
ALLOWED = ("available", "date-required", "sold-out", "closed", "unavailable", "free", "not-published", "unknown")
STATUS_OF = {"available": "available", "date-required": "date-required", "sold-out": "unavailable", "closed": "unavailable", "unavailable": "unavailable", "free": "free", "not-published": "not-published"}
KEPT_BASE_REASONS = ("pax_failed", "tour_grades_failed", "tour_grades_empty")


def pricing_issues(prices: DataFrame, packages: DataFrame, key: str) -> DataFrame:
    """(key, code): broken invariants of prices and of their packages, each code once a price or a package.

    prices: (key, status, availability, message, source, reason, base_price, booking_date, travelers) and an optional
    provenance (kind, same_identity, checked_at, failure). packages: (key, name, description, total_price, party,
    unit_price, unit, availability, availability_message, extras array<struct<amount, source_text, unit>>); texts."""
    empty = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    negative = F.col("availability").isin(*NEGATIVE_RANK)
    expected = F.when(negative & ~empty("base_price") & F.coalesce(F.col("reason").isin(*KEPT_BASE_REASONS), F.lit(False)), None).otherwise(F.try_element_at(F.create_map(*(F.lit(x) for kv in STATUS_OF.items() for x in kv)), F.col("availability")))
    nan = lambda *cs: F.concat_ws(" ", *cs).rlike(r"(?i)\b(?:nan|undefined)\b")
    rules = {
        "pricing-field": F.col("base_price").isNull() | F.col("booking_date").isNull() | F.col("travelers").isNull(),
        "availability-type": F.col("availability").isNull(), "availability-status": ~F.col("availability").isin(*ALLOWED),
        "availability-field": (F.col("availability") != "unknown") & (empty("message") | empty("source")), "pricing-status": ~F.col("status").eqNullSafe(expected),
        "pricing-nan": nan("base_price", "booking_date", "travelers", "message", "source", "reason", "status"),
    }
    if "provenance" in prices.columns:
        p, has = (lambda f: F.col(f"provenance.{f}")), F.col("provenance").isNotNull()
        rules |= {
            "pricing-provenance-fields": has & F.coalesce(p("kind").isNull() | p("same_identity").isNull() | p("checked_at").isNull() | p("failure").isNull(), F.lit(True)), "pricing-provenance-kind": has & ~p("kind").eqNullSafe(F.lit("rendered-fallback")),
            "pricing-provenance-identity": has & ~F.coalesce(p("same_identity"), F.lit(False)), "pricing-provenance-date": has & F.try_to_date(p("checked_at"), "yyyy-MM-dd").isNull(),
            "pricing-provenance-reason": has & ~F.coalesce(p("failure").isin(*LOOKUP_REASONS), F.lit(False)),
        }
    package_rules = {
        "package-field": F.col("name").isNull() | F.col("description").isNull() | F.col("total_price").isNull() | F.col("party").isNull() | F.col("unit_price").isNull() | F.col("unit").isNull(),
        "package-availability": ~F.coalesce(F.col("availability").isin(*ALLOWED), F.lit(False)), "package-availability-message": negative & empty("availability_message"),
        "standalone-total": ~empty("total_price") & (F.col("party") == "") & (~empty("unit_price") | ~empty("unit")), "package-unit": empty("unit_price") != empty("unit"),
        "additional-cost": F.exists("extras", lambda x: F.coalesce(x["amount"] == "", F.lit(True)) | F.coalesce(x["source_text"] == "", F.lit(True))), "additional-cost-unit": F.exists("extras", lambda x: F.trim(x["unit"]) == ""),
        "pricing-nan": nan("name", "description", "total_price", "party", "unit_price", "unit", "availability_message"),
    }
    found = lambda rules: F.explode(F.array_compact(F.array(*(F.when(F.coalesce(t, F.lit(False)), F.lit(c)) for c, t in rules.items())))).alias("code")
    content = F.xxhash64(*[c for c in packages.columns if c != key])
    twice = packages.groupBy(key, content.alias("_c")).agg(F.count("*").alias("_n")).where("_n > 1").select(key, F.lit("package-duplicate").alias("code"))
    per = packages.groupBy(key).agg(F.bool_and(F.coalesce(F.col("availability").isin(*NEGATIVE_RANK), F.lit(False))).alias("_all"), F.bool_or(F.col("availability") == "available").alias("_some"))
    both = prices.select(key, negative.alias("_neg")).join(per, key)
    against = found({"package-global-availability": F.col("_all") & ~F.coalesce("_neg", F.lit(False)), "package-global-contradiction": F.col("_neg") & F.col("_some")})
    return prices.select(key, found(rules)).union(packages.select(key, found(package_rules))).union(twice).union(both.select(key, against)).distinct()


def raw_price_issues(raw: DataFrame, stored: DataFrame, prices: DataFrame, key: str) -> DataFrame:
    """(key, code): what a second extraction from the pages' texts finds against the stored packages.

    raw: (key, at, surface), the text of each package on the page, and (key, at -1, surface) of the base price; stored:
    (key, at, total_price, unit_price, unit, availability) as texts; prices: (key, base_price)."""
    from wayforge.functions import text as T

    money = T.MONEY.removeprefix("(?i)")
    value = lambda c: F.struct(T.amount(c).alias("a"), T.currency(c).alias("c"))
    token = lambda c, pattern, i: F.nullif(F.regexp_extract(c, f"(?i){pattern}", i), F.lit(""))
    s = F.col("surface")
    total = token(s, rf"\bTotal price:\s*{money}", 1)
    party = token(s, rf"\bTotal price:\s*{money}\s+for\s+([^.;]+)", 2)
    charge = rf"([0-9]+)\s+(Adults?|Seniors?|Youths?|Children|Infants)\s+x\s+{money}"
    seen = raw.where("at >= 0").select(key, "at", total.alias("_total"), party.alias("_party"), F.lower(token(s, charge, 2)).alias("_kind"), token(s, charge, 3).alias("_charge"), s.rlike(T.MONEY).alias("_money"))
    both = seen.join(stored, [key, "at"])
    none = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    due = F.col("_charge").isNotNull() & (F.col("_total").isNull() | F.col("_party").isNotNull())
    differ = lambda x, y: ~value(F.col(x)).eqNullSafe(value(F.col(y)))
    rules = {
        "raw-total-missing": F.col("_total").isNotNull() & none("total_price"), "raw-total-mismatch": F.col("_total").isNotNull() & ~none("total_price") & differ("_total", "total_price"),
        "raw-charge-missing": due & (none("unit_price") | none("unit")), "raw-charge-price-mismatch": due & ~none("unit_price") & ~none("unit") & differ("_charge", "unit_price"),
        "raw-charge-unit-mismatch": due & ~none("unit_price") & ~none("unit") & (F.lower("unit") != F.col("_kind")), "raw-priced-surface-empty": (F.col("availability") == "available") & F.col("_money") & none("total_price") & none("unit_price"),
    }
    found = lambda rules: F.explode(F.array_compact(F.array(*(F.when(F.coalesce(t, F.lit(False)), F.lit(c)) for c, t in rules.items())))).alias("code")
    counts = seen.groupBy(key).agg(F.count("*").alias("_n")).join(stored.groupBy(key).agg(F.count("*").alias("_m")), key, "full_outer").where("coalesce(_n, 0) <> coalesce(_m, 0)").select(key, F.lit("raw-package-count").alias("code"))
    base = raw.where("at = -1").select(key, F.get(T.money_mentions(s), F.lit(0)).alias("_base")).where("_base is not null").join(prices, key)
    base_rules = {"raw-base-price-missing": none("base_price"), "raw-base-price-mismatch": ~none("base_price") & differ("_base", "base_price")}
    return both.select(key, found(rules)).union(base.select(key, found(base_rules))).union(counts).distinct()


def with_fallback(primary: DataFrame, rendered: DataFrame, key: str) -> DataFrame:
    """primary (status, reason, identity, price) with ``provenance``: where its lookup failed for a listed reason, the
    rendered evidence (identity, checked_at, booking_date, travelers, packages, price) of the same identity takes its
    place, if it has a date, a party and packages; ``reason`` then says why."""
    r = rendered.select(key, *(F.col(c).alias(f"_{c}") for c in ("identity", "checked_at", "booking_date", "travelers", "packages", "price")))
    said = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    good = F.col("reason").isin(*LOOKUP_REASONS) & (F.col("_identity") == F.col("identity")) & F.try_to_date("_checked_at", "yyyy-MM-dd").isNotNull() & said("_booking_date") & said("_travelers") & (F.col("_packages") > 0)
    good, ok = F.coalesce(good, F.lit(False)), F.col("status") == "ok"
    out = primary.join(r, key, "left")
    return out.select(key, F.when(ok, F.col("price")).when(good, F.col("_price")).alias("price"), F.when(ok, "primary").when(good, "rendered-fallback").otherwise("none").alias("provenance"), F.when(~ok & good, F.col("reason")).alias("reason"))
