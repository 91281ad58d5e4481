"""Logs of queries whose expectations come from earlier answers of the same log.

A log is one JSON document a key: the attempts of each query in order, with variables and the answer kept, and what was
selected on the way. The detail answer gives the product code of all later queries; the calendar's advertised dates give
the dates that may be tried for passengers, one after another, each only after the one before has failed; the date and
mix that succeed give the variables of the package query; and the answers together give what must have been stored."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayforge.functions.nested import json_fields, json_names
from wayforge.sources.pages import identity

_ATTEMPTS = "array<struct<variables: string, evidenceResponse: string>>"
QUERIES = ("detail", "reviews", "priceCalendar", "cancellation", "pax", "packages")
#: What is read of a log; nested answers stay JSON.
LOG = (
    f"checkedAt string, queries struct<{', '.join(f'{q}: {_ATTEMPTS}' for q in QUERIES)}>, reviewSelection string, "
    "selection struct<travelDate: string, travelDateSource: string, paxAttemptedDates: array<string>, paxDatePolicy: string, selectedLanguage: string, passengerMix: string, packageOptionsStatus: string, packageOptionsUnavailableReason: string>"
)
STORED = "base_price string, booking_date string, travelers string, availability struct<status: string>, packages array<struct<name: string, total_price: string>>"
#: States of a poll that end it, the most polls of one date, dates tried, reviews kept; sources and policies by name.
SETTLED, POLLS, DATES, REVIEWS = ("SUCCESS", "FAILED"), 3, 5, 10
DATE_SOURCE, DATE_POLICY, REVIEW_POLICY = "priceCalendar.datesAndPrices", "earliest-advertised", "explicit-location-only"
REVIEW_VARIABLES = {"filters": "[]", "limit": "10", "offset": "0", "sortType": '"DEFAULT"', "sortBy": '"DATE"', "language": '"en"', "doMachineTranslation": "true"}
REVIEW_FIELDS = ("id", "locationId", "title", "text", "rating", "publishedDate", "language")
SELECTION_FIELDS = ("policy", "requestedLocationId", "sourceTotalCount", "returnedCount", "acceptedCount", "quarantinedCount", "missingLocationIdCount", "rejectedLocationIds")
#: Parts of a detail answer that may have failed alone.
PARTIAL = ("fullProduct", "0", "aboutOperator")


def _amount(text: Column) -> Column:
    """The number in a stored or raw price."""
    return F.regexp_replace(text, "[^0-9.]", "").try_cast("decimal(18,2)")


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def advertised_dates(calendar: Column, checked_on: Column, cutoff_hours: Column, most: int = DATES) -> Column:
    """The first dates of a calendar (array of date and price) with a price, from max(1, ceil(hours / 24) + 1) days after
    the check on."""
    lead = F.greatest(F.lit(1), F.ceil(F.greatest(F.coalesce(cutoff_hours, F.lit(0.0)), F.lit(0.0)) / 24) + 1).cast("int")
    first = F.date_add(checked_on, lead).cast("string")
    return F.slice(F.array_sort(F.array_distinct(F.transform(F.filter(calendar, lambda r: (r["date"] >= first) & (r["price"] >= 0)), lambda r: r["date"]))), 1, most)


def log_issues(logs: DataFrame, key: str, denied: list[str]) -> DataFrame:
    """(key, code) of logs (key, route venue or product, detail_id, evidence JSON, stored JSON), each code once a key.

    denied: names of personal fields, in small letters without underscores, that no answer may hold. What a broken part
    makes unknowable is not judged: without a product code nothing of prices is."""
    e, stored = F.from_json("evidence", LOG), F.from_json("stored", STORED)
    a = {q: F.coalesce(F.col(f"_e.queries.{q}"), F.array().cast(_ATTEMPTS)) for q in QUERIES}
    df = logs.select(key, "route", "detail_id", e.alias("_e"), stored.alias("_s")).withColumns({f"_{q}": a[q] for q in QUERIES})
    df = df.withColumns({f"_{q}_v": json_fields(F.transform(f"_{q}", lambda x: x["variables"])) for q in QUERIES if q != "detail"} | {"_detail_v": json_fields(F.transform("_detail", lambda x: x["variables"]))})
    answers = functools.reduce(F.concat, [F.transform(f"_{q}", lambda x: x["evidenceResponse"]) for q in QUERIES])
    block = F.get_json_object(F.get("_reviews", F.lit(0))["evidenceResponse"], "$.data.ReviewsProxy_getReviewListPageForLocation[0]")
    product = F.get_json_object(F.get("_detail", F.lit(0))["evidenceResponse"], "$.data.fullProduct[0]")
    calendar = F.from_json(F.get_json_object(F.get("_priceCalendar", F.lit(0))["evidenceResponse"], "$.data.priceCalendar[0].datesAndPrices"), "array<struct<date: string, price: decimal(18,2)>>")
    status = lambda q, path: F.transform(f"_{q}", lambda x: F.get_json_object(x["evidenceResponse"], path))
    df = df.withColumns({
        "_names": json_names(_may_hold(answers, denied)), "_mix": json_fields(F.array(F.concat(F.lit('{"x":'), F.col("_e.selection.passengerMix"), F.lit("}")))), "_block": block, "_product": product, "_calendar": F.coalesce(calendar, F.array().cast("array<struct<date: string, price: decimal(18,2)>>")),
        "_pax_states": status("pax", "$.data.paxMix.resultStatus"), "_pack_states": status("packages", "$.data.tourGrades.resultStatus"),
        "_failed": _failed(product), "_pax_dates": F.transform("_pax_v", lambda m: m["travelDate"]), "_sel": F.col("_e.selection"), "_chosen": json_fields(F.array("_e.reviewSelection")),
    })
    reviews = F.from_json(F.get_json_object("_block", "$.reviews"), "array<string>")
    grades = F.from_json(F.get_json_object(F.try_element_at("_packages", F.lit(-1))["evidenceResponse"], "$.data.tourGrades.result.tourGrades"), "array<struct<title: string, price: string>>")
    checked = F.substring("_e.checkedAt", 1, 10).try_cast("date")
    df = df.withColumns({
        "_reviews_v1": F.get("_reviews_v", F.lit(0)), "_rows": json_fields(reviews), "_total": F.get_json_object("_block", "$.totalCount").try_cast("long"), "_code": F.get_json_object("_product", "$.productCode"),
        "_tried": F.coalesce(F.col("_sel.paxAttemptedDates"), F.array().cast("array<string>")), "_chosen": F.get("_chosen", F.lit(0)), "_row": F.get(F.filter("_calendar", lambda r: r["date"] == F.col("_sel.travelDate")), F.lit(0)),
        "_dates": advertised_dates(F.col("_calendar"), checked, F.get_json_object("_product", "$.cutoffHours").try_cast("double")), "_grades": F.coalesce(grades, F.array().cast("array<struct<title: string, price: string>>")),
    })
    df = df.withColumn("_ids", F.transform("_rows", lambda m: m["id"])).withColumn("_polls", F.transform("_pax_dates", lambda d, i: F.struct(d.alias("d"), F.get("_pax_states", i).alias("s"))))
    df = df.withColumn("_date_rows", F.transform("_tried", lambda d: F.filter("_polls", lambda x: x["d"] == _quoted(d))))
    df = df.withColumns({"_tried_json": F.transform("_tried", _quoted), "_language": F.coalesce(_quoted(F.get_json_object("_product", "$.languages[0]")), F.lit("null")), "_package_want": _package_want(), "_priced": _priced()})
    rules = {**_review_rules(denied), **_detail_rules(), **_date_rules(), **_package_rules()}
    found = F.array(*(F.when(F.coalesce(rule, F.lit(False)), F.lit(code)) for code, rule in rules.items()))
    # as a column of its own: what explode is given is interpreted for each row, a projection is compiled
    return df.select(key, found.alias("_found")).select(key, F.explode(F.array_compact("_found")).alias("code"))


def _may_hold(answers: Column, denied: list[str]) -> Column:
    """The answers in whose text a name of ``denied`` stands in whatever letters, or an escape that may be a part of one: all
    others have no such field, whatever else they hold."""
    if not all(n.isascii() and n.isalnum() for n in denied):
        return answers  # such a name may be written with other escapes
    plain = lambda x: F.lower(F.replace(x, F.lit("_"), F.lit("")))
    held = lambda x: functools.reduce(lambda a, n: a | F.contains(plain(x), F.lit(n)), denied, F.contains(x, F.lit("\\u")))
    return F.filter(answers, held)


def _failed(product: Column) -> Column:
    """Whether an answer has errors; those of a product's detail may lie in PARTIAL. Only texts that hold the field's name, or an
    escape that may be in it, are parsed for it."""
    named = lambda x: F.contains(x, F.lit("errors")) | F.contains(x, F.lit("\\u"))
    texts = lambda q: F.filter(F.transform(f"_{q}", lambda x: x["evidenceResponse"]), named)
    errors = lambda x: F.from_json(F.get_json_object(x, "$.errors"), "array<struct<path: array<string>>>")
    partial = lambda r: (F.slice(r["path"], 1, 3) == F.array(*map(F.lit, PARTIAL))) & product.isNotNull()
    detail = F.exists(texts("detail"), lambda x: F.coalesce(F.exists(errors(x), lambda r: ~F.coalesce(partial(r), F.lit(False))), F.lit(False)))
    return detail | F.exists(F.concat(*(texts(q) for q in QUERIES if q != "detail")), lambda x: F.coalesce(F.size(errors(x)) > 0, F.lit(False)))


def _review_rules(denied: list[str]) -> dict[str, Column]:
    """Personal fields, and the reviews against their query and selection."""
    venue, own = F.col("route") == "venue", F.col("detail_id").cast("string")
    v, rows = F.col("_reviews_v1"), F.col("_rows")
    plain = lambda m, name: F.regexp_replace(m[name], '^"|"$', "")
    wrong = functools.reduce(lambda x, y: x | y, [~F.coalesce(v[n] == want, F.lit(False)) for n, want in REVIEW_VARIABLES.items()])
    of_other = F.exists(rows, lambda m: F.when(venue, ~plain(m, "locationId").eqNullSafe(own) | (m["locationId"] == "null")).otherwise((m["locationId"] != "null") & (plain(m, "locationId") != own)))
    block, c = F.col("_block").isNotNull(), F.col("_chosen")
    n = {k: c[k].try_cast("long") for k in SELECTION_FIELDS if k.endswith("Count")}
    rejected = F.from_json(c["rejectedLocationIds"], "array<string>")
    counts = F.array(*n.values())
    selection = c.isNull() | (F.array_sort(F.map_keys(c)) != F.array(*(F.lit(k) for k in sorted(SELECTION_FIELDS)))) | (c["policy"] != f'"{REVIEW_POLICY}"') | (plain(c, "requestedLocationId") != own)
    selection = selection | F.exists(counts, lambda x: x.isNull() | (x < 0)) | (n["returnedCount"] != n["acceptedCount"] + n["quarantinedCount"]) | (n["missingLocationIdCount"] > n["quarantinedCount"]) | (n["sourceTotalCount"] < n["acceptedCount"])
    selection = selection | (F.col("_total") != n["acceptedCount"]) | (F.size(rows) != n["acceptedCount"]) | rejected.isNull() | (rejected != F.array_sort(F.array_distinct(rejected))) | F.array_contains(rejected, own) | F.array_contains(rejected, "")
    unique = F.size(F.array_distinct(F.filter("_ids", lambda x: x.isNotNull() & (x != "null"))))
    asked = F.size("_reviews") > 0
    return {
        "graphql-errors": F.col("_failed"), "graphql-privacy": F.exists("_names", lambda x: F.lower(F.replace(x, F.lit("_"), F.lit(""))).isin(*denied)),
        "graphql-query-missing": ~asked | (F.size("_detail") == 0), "graphql-review-attempts": F.size("_reviews") > 1, "graphql-review-variables": asked & wrong,
        "graphql-review-identity": asked & (~plain(v, "locationId").eqNullSafe(own) | F.coalesce(of_other, F.lit(False))),
        "graphql-review-projection": asked & ((venue & ~F.coalesce(v["photosPerReviewLimit"] == "7", F.lit(False))) | F.coalesce(F.exists(rows, lambda m: F.size(F.array_except(F.map_keys(m), F.array(*map(F.lit, REVIEW_FIELDS)))) > 0), F.lit(False))),
        "graphql-review-block": asked & ~block, "graphql-review-total": block & (F.col("_total").isNull() | (F.col("_total") < 0)), "graphql-reviews": block & rows.isNull(),
        "graphql-review-unique": F.exists("_ids", lambda x: x.isNull() | (x == "null")) | (unique != F.size("_ids")), "graphql-review-selection": venue & block & rows.isNotNull() & selection,
        "review-coverage": block & (F.size("_ids") < F.least(F.lit(REVIEWS), F.col("_total"))),
    }


def _sorted(m: Column) -> Column:
    return F.array_sort(F.map_entries(m))


def _priced() -> Column:
    """The variables of queries for a product's prices."""
    return _sorted(F.create_map(F.lit("currency"), F.lit('"USD"'), F.lit("productCode"), _quoted(F.col("_code"))))


def _package_want() -> Column:
    """The variables of the package query."""
    return _sorted(F.create_map(F.lit("productCode"), _quoted(F.col("_code")), F.lit("travelDate"), _quoted(F.col("_sel.travelDate")), F.lit("passengerMix"), F.get("_mix", F.lit(0))["x"], F.lit("currencies"), F.lit('["USD"]'), F.lit("locale"), F.lit('"en-US"')))


def _detail_rules() -> dict[str, Column]:
    """The product of the detail answer, and the queries that name it."""
    product, own = (F.col("route") == "product") & (F.size("_detail") > 0), F.col("detail_id").cast("string")
    expected = F.create_map(F.lit("activityId"), own, F.lit("currency"), F.lit('"USD"'), F.lit("language"), F.lit('"en"'))
    coded = product & F.col("_code").isNotNull()
    once = lambda q: ~F.coalesce((F.size(f"_{q}") == 1) & (_sorted(F.get(f"_{q}_v", F.lit(0))) == F.col("_priced")), F.lit(False)) & (F.size(f"_{q}") > 0)
    return {
        "graphql-detail-variables": product & ~F.coalesce(_sorted(F.get("_detail_v", F.lit(0))) == _sorted(expected), F.lit(False)), "graphql-detail-identity": product & ~F.get_json_object("_product", "$.activityId").eqNullSafe(own),
        "graphql-selection": product & ~F.col("_sel.travelDateSource").eqNullSafe(F.lit(DATE_SOURCE)), "graphql-price-variables": coded & (once("priceCalendar") | once("cancellation")),
        "graphql-price-query-missing": coded & ((F.size("_priceCalendar") == 0) | (F.size("_cancellation") == 0)),
    }


def _settles(states: Column) -> Column:
    return F.exists(F.slice(states, 1, F.greatest(F.size(states) - 1, F.lit(0))), lambda s: s.isin(*SETTLED))


def _date_rules() -> dict[str, Column]:
    """Dates that were tried for passengers against those that the calendar advertised, and what was stored of the price."""
    coded, day, tried, states = (F.col("route") == "product") & F.col("_code").isNotNull(), F.col("_sel.travelDate"), F.col("_tried"), F.col("_pax_states")
    asked = coded & (F.size("_pax") > 0)
    usable = (F.size(tried) > 0) & (F.size(tried) <= DATES) & (F.size(F.array_distinct(tried)) == F.size(tried)) & (F.try_element_at(tried, F.lit(-1)) == day)
    every = F.col("_pax_dates")
    changes = F.filter(F.transform(every, lambda d, i: F.when((i == 0) | ~d.eqNullSafe(F.get(every, i - 1)), F.coalesce(d, F.lit("null")))), lambda d: d.isNotNull())
    fixed = F.exists("_pax_v", lambda m: ~F.coalesce((m["currencies"] == '["USD"]') & (m["locale"] == '"en-US"') & (m["productCode"] == _quoted(F.col("_code"))), F.lit(False)))
    language = F.col("_language")
    groups, own = F.col("_date_rows"), lambda g: F.transform(g, lambda x: x["s"])
    last = F.try_element_at(states, F.lit(-1))
    failed = asked & (last == "FAILED")
    numbers = F.aggregate(F.regexp_extract_all("_s.travelers", F.lit("([0-9]+)"), 1), F.lit(0), lambda x, y: x + y.cast("int"))
    mix = F.aggregate(F.from_json("_sel.passengerMix", "array<struct<count: int>>"), F.lit(0), lambda x, y: x + F.coalesce(y["count"], F.lit(0)))
    return {
        "graphql-price-date": coded & day.isNotNull() & F.col("_row").isNull(), "graphql-base-price": coded & F.col("_row").isNotNull() & ~(failed & (F.coalesce("_s.base_price", F.lit("")) == "")) & ~F.col("_row.price").eqNullSafe(_amount(F.col("_s.base_price"))),
        "graphql-booking-date": coded & ~F.col("_s.booking_date").eqNullSafe(F.coalesce(day, F.lit(""))),
        "graphql-pax-variables": asked & (fixed | F.exists(every, lambda d: ~F.coalesce(F.array_contains("_tried_json", d), F.lit(False)))),
        "graphql-pax-dates": asked & (~F.coalesce(usable, F.lit(False)) | (usable & ~F.exists(every, lambda d: ~F.coalesce(F.array_contains("_tried_json", d), F.lit(False))) & (F.size(F.array_distinct(changes)) == F.size(changes)) & (changes != F.col("_tried_json")))),
        "graphql-pax-date-order": asked & (F.size(F.array_distinct(changes)) < F.size(changes)), "graphql-pax-date-policy": asked & ~F.col("_sel.paxDatePolicy").eqNullSafe(F.lit(DATE_POLICY)),
        "graphql-pax-date-prefix": asked & usable & (tried != F.slice("_dates", F.lit(1), F.size(tried))),
        "graphql-pax-language-provenance": asked & (~F.coalesce(_quoted(F.col("_sel.selectedLanguage")), F.lit("null")).eqNullSafe(language) | F.exists("_pax_v", lambda m: ~F.coalesce(m["selectedLanguage"], F.lit("null")).eqNullSafe(language))),
        "graphql-pax-poll-bound": asked & F.exists(groups, lambda g: F.size(g) > POLLS), "graphql-pax-after-settle": asked & F.exists(groups, lambda g: _settles(own(g))),
        "graphql-pax-unsettled": asked & F.exists(groups, lambda g: (F.size(g) > 0) & ~F.coalesce(F.try_element_at(own(g), F.lit(-1)).isin(*SETTLED), F.lit(False))),
        "graphql-pax-retry-cause": asked & F.exists(F.slice(groups, 1, F.greatest(F.size(groups) - 1, F.lit(0))), lambda g: (F.size(g) > 0) & (F.try_element_at(own(g), F.lit(-1)) == "SUCCESS")),
        "graphql-pax-provenance": failed & ~((F.col("_sel.packageOptionsStatus") == "UNKNOWN") & F.col("_sel.packageOptionsUnavailableReason").eqNullSafe(F.lit("pax_failed"))),
        "graphql-pax-failed-state": failed & ~F.col("_s.availability.status").eqNullSafe(F.lit("unknown")), "graphql-pax-failed-price": failed & F.col("_row").isNotNull() & (F.coalesce("_s.base_price", F.lit("")) == ""),
        "graphql-travelers": coded & (mix > 0) & (numbers != mix),
    }


def _package_rules() -> dict[str, Column]:
    """The package query against the selection, and the stored packages against its answer."""
    asked = (F.col("route") == "product") & F.col("_code").isNotNull() & (F.size("_packages") > 0)
    states, grades, kept = F.col("_pack_states"), F.col("_grades"), F.coalesce(F.col("_s.packages"), F.array().cast("array<struct<name: string, total_price: string>>"))
    rows = F.size(grades) > 0
    reason = F.when((F.try_element_at(states, F.lit(-1)) == "SUCCESS") & rows, None).when(F.try_element_at(states, F.lit(-1)) == "SUCCESS", "tour_grades_empty").otherwise("tour_grades_failed")
    ok = F.when((F.try_element_at(states, F.lit(-1)) == "SUCCESS") & rows, "AVAILABLE").otherwise("UNKNOWN")
    both = F.filter(F.transform(grades, lambda g, i: F.struct(g.alias("g"), F.get(kept, i).alias("k"))), lambda x: x["g"].isNotNull() & x["k"].isNotNull())
    return {
        "graphql-package-poll-bound": asked & (F.size("_packages") > POLLS), "graphql-package-variables": asked & F.exists("_packages_v", lambda m: ~F.coalesce(_sorted(m) == F.col("_package_want"), F.lit(False))),
        "graphql-package-after-settle": asked & _settles(states), "graphql-package-provenance": asked & ~(F.col("_sel.packageOptionsStatus").eqNullSafe(ok) & F.col("_sel.packageOptionsUnavailableReason").eqNullSafe(reason)),
        "graphql-package-count": asked & (F.size(grades) != F.size(kept)), "graphql-package-name": asked & F.exists(both, lambda x: (F.coalesce(x["g"]["title"], F.lit("")) != "") & ~F.trim(F.regexp_replace(x["g"]["title"], r"\s+", " ")).eqNullSafe(x["k"]["name"])),
        "graphql-package-price": asked & F.exists(both, lambda x: ~_amount(x["g"]["price"]).eqNullSafe(_amount(x["k"]["total_price"]))),
    }


#: Failures of the log after which a rendered page may stand in, what such prices are called, and what pages
#: say that are no evidence.
FALLBACK_REASONS, RENDERED = ("pax_failed", "tour_grades_failed", "tour_grades_empty"), "rendered-exact-page"
BLOCKED = "captcha|verify you are human|unusual traffic"
PROVENANCE = ("kind", "identity", "canonical_url", "checked_at", "reason")


def fallback_issues(selections: DataFrame, stored: DataFrame, rendered: DataFrame, key: str, least: int = 30_000) -> DataFrame:
    """(key, code) of prices that were taken from a rendered page where the log has none.

    selections: (key, identity, reason), what the log ended with; stored: (key, provenance struct of PROVENANCE, texts);
    rendered: (key, html, canonical_url, checked_at, booking_date, travelers, packages array of texts). A claim is judged by the
    first step that fails: the log's reason, the page, its identity, its prices, their scope, and the provenance; where all
    hold and nothing is claimed, the fallback is missing."""
    df = selections.select(key, "identity", "reason").join(stored.select(key, F.col("provenance").alias("_p")), key, "left").join(rendered, key, "left")
    claimed, size, low = F.coalesce(F.col("_p.kind") == RENDERED, F.lit(False)), F.octet_length("html"), F.lower("html")
    empty = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    none = F.coalesce(F.size("packages"), F.lit(0)) <= 0
    want = {"kind": F.lit(RENDERED), "identity": F.col("identity"), "canonical_url": F.col("canonical_url"), "checked_at": F.col("checked_at"), "reason": F.col("reason")}
    differs = functools.reduce(lambda x, y: x | y, [~F.col(f"_p.{n}").eqNullSafe(want[n]) for n in PROVENANCE])
    steps = (
        F.when(~F.coalesce(F.col("reason").isin(*FALLBACK_REASONS), F.lit(False)), "fallback-graphql-state").when(F.col("html").isNull(), "fallback-raw-missing")
        .when((size < least) | ~F.contains(low, F.lit("<html")) | low.rlike(BLOCKED), "fallback-raw-invalid").when(~identity(F.col("canonical_url")).eqNullSafe(F.col("identity")), "fallback-identity")
        .when(empty("booking_date") & empty("travelers") & none, "fallback-pricing").when(empty("booking_date") | empty("travelers") | none, "fallback-package-scope")
    )
    code = F.when(claimed, F.coalesce(steps, F.when(differs, "fallback-provenance"))).when(steps.isNull(), "fallback-missing")
    return df.select(key, code.alias("code")).where("code is not null")
