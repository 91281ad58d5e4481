"""Request logs made from orders: a log without faults for each kind of page, and one change for each code."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from wayforge.operators import requestlogs
from wayforge.plans.registry import query, read, spread
from wayforge.sources.pages import identity

ID = "@ID@"


def _attempt(variables: dict, data: dict, **more) -> dict:
    return {"variables": variables, "evidenceResponse": {"data": data, **more}}


def _reviews(venue: bool) -> dict:
    rows = [{"id": i, "locationId": ID if venue else None, "title": "t", "text": "x", "rating": 5} for i in (11, 12)]
    variables = {"filters": [], "limit": 10, "offset": 0, "sortType": "DEFAULT", "sortBy": "DATE", "language": "en", "doMachineTranslation": True, "locationId": ID}
    return _attempt(variables | ({"photosPerReviewLimit": 7} if venue else {}), {"ReviewsProxy_getReviewListPageForLocation": [{"totalCount": 2, "reviews": rows}]})


SELECTION = {"policy": requestlogs.REVIEW_POLICY, "requestedLocationId": ID, "sourceTotalCount": 3, "returnedCount": 3, "acceptedCount": 2, "quarantinedCount": 1, "missingLocationIdCount": 1, "rejectedLocationIds": ["x1", "x2"]}
VENUE = {"checkedAt": "2024-05-01T10:00:00Z", "queries": {"detail": [_attempt({}, {"venue": {"note": "fine"}})], "reviews": [_reviews(True)]}, "reviewSelection": SELECTION}
PRODUCT = {"activityId": ID, "productCode": "C-9", "cutoffHours": 30, "languages": ["en"]}
#: Thirty hours of notice: from three days after the check on.
CALENDAR = [{"date": f"2024-05-0{d}", "price": p} for d, p in ((2, 9), (3, 9), (4, 25.5), (6, 30), (5, -1), (8, 40))]


def _pax(day: str, status: str) -> dict:
    return _attempt({"currencies": ["USD"], "locale": "en-US", "productCode": "C-9", "travelDate": day, "selectedLanguage": "en"}, {"paxMix": {"resultStatus": status}})


def _log(pax: list, packages: list, **selection) -> dict:
    chosen = {"travelDate": "2024-05-06", "travelDateSource": requestlogs.DATE_SOURCE, "paxAttemptedDates": ["2024-05-04", "2024-05-06"], "paxDatePolicy": requestlogs.DATE_POLICY, "selectedLanguage": "en"}
    priced = {"currency": "USD", "productCode": "C-9"}
    queries = {
        "detail": [_attempt({"activityId": 0, "currency": "USD", "language": "en"}, {"fullProduct": [PRODUCT]}, errors=[{"path": ["fullProduct", 0, "aboutOperator", "name"]}])], "reviews": [_reviews(False)],
        "priceCalendar": [_attempt(priced, {"priceCalendar": [{"datesAndPrices": CALENDAR}]})], "cancellation": [_attempt(priced, {"cancellation": []})], "pax": pax, "packages": packages,
    }
    return {"checkedAt": "2024-05-01T10:00:00Z", "queries": queries, "selection": chosen | selection}


MIX = [{"band": "ADULT", "count": 2}]
GRADES = [{"title": "Small  tour", "price": "60.00"}, {"title": "Large tour", "price": "95.50"}]
_PACKAGE_VARIABLES = {"productCode": "C-9", "travelDate": "2024-05-06", "passengerMix": MIX, "currencies": ["USD"], "locale": "en-US"}
_POLLED = [_attempt(_PACKAGE_VARIABLES, {"tourGrades": {"resultStatus": s, "result": {"tourGrades": GRADES}}}) for s in ("PENDING", "SUCCESS")]
BOOKED = _log([_pax("2024-05-04", "PENDING"), _pax("2024-05-04", "FAILED"), _pax("2024-05-06", "SUCCESS")], _POLLED, passengerMix=MIX, packageOptionsStatus="AVAILABLE", packageOptionsUnavailableReason=None)
FAILED = _log([_pax("2024-05-04", "FAILED"), _pax("2024-05-06", "FAILED")], [], packageOptionsStatus="UNKNOWN", packageOptionsUnavailableReason="pax_failed")
STORED = {"base_price": "USD 30", "booking_date": "2024-05-06", "travelers": "2 adults", "availability": {"status": "available"}, "packages": [{"name": "Small tour", "total_price": "$60"}, {"name": "Large tour", "total_price": "$95.50"}]}
UNSURE = {"base_price": "USD 30", "booking_date": "2024-05-06", "availability": {"status": "unknown"}}
_TEXT = {k: json.dumps(v, separators=(",", ":")).replace('"activityId":0', '"activityId":' + ID) for k, v in {"venue": VENUE, "booked": BOOKED, "failed": FAILED}.items()}
_KEPT = {"venue": "{}", "booked": json.dumps(STORED, separators=(",", ":")), "failed": json.dumps(UNSURE, separators=(",", ":"))}


def _day(day: str, status: str) -> str:
    return json.dumps(_pax(day, status), separators=(",", ":"))


#: (code, log, what is changed, into what, whether in what is stored): each makes that one code.
CHANGES = [
    (None, "venue", "", "", False), (None, "booked", "", "", False), (None, "failed", "", "", False),
    ("graphql-errors", "venue", '{"venue":{"note":"fine"}}', '{"venue":{"note":"fine"}},"errors":[{"path":["venue"]}]', False),
    ("graphql-errors", "booked", '"path":["fullProduct",0,"aboutOperator","name"]', '"path":["fullProduct",1,"aboutOperator","name"]', False),
    ("graphql-privacy", "venue", '"note":"fine"', '"note":{"Display_Name":"x"}', False),
    ("graphql-query-missing", "venue", '"detail":[', '"other":[', False),
    ("graphql-review-variables", "venue", '"limit":10', '"limit":"10"', False), ("graphql-review-variables", "booked", '"doMachineTranslation":true', '"doMachineTranslation":false', False),
    ("graphql-review-identity", "venue", '"id":12,"locationId":"@ID@"', '"id":12,"locationId":null', False), ("graphql-review-identity", "booked", '"id":12,"locationId":null', '"id":12,"locationId":"x1"', False),
    ("graphql-review-projection", "venue", '"photosPerReviewLimit":7', '"photosPerReviewLimit":8', False), ("graphql-review-projection", "booked", '"text":"x","rating":5},', '"text":"x","mood":5},', False),
    ("graphql-review-block", "booked", "ReviewsProxy_getReviewListPageForLocation", "ReviewsProxy_other", False), ("graphql-review-total", "booked", '"totalCount":2', '"totalCount":-2', False),
    ("graphql-reviews", "booked", '"totalCount":2,"reviews"', '"totalCount":0,"rows"', False), ("graphql-review-unique", "booked", '"totalCount":2,"reviews":[{"id":11', '"totalCount":2,"reviews":[{"id":12', False),
    ("graphql-review-selection", "venue", requestlogs.REVIEW_POLICY, "any", False), ("graphql-review-selection", "venue", '"returnedCount":3', '"returnedCount":4', False), ("graphql-review-selection", "venue", '["x1","x2"]', '["x2","x1"]', False),
    ("graphql-review-selection", "venue", '"rejectedLocationIds"', '"rejected"', False), ("review-coverage", "booked", '"totalCount":2', '"totalCount":3', False),
    ("graphql-detail-variables", "booked", '"activityId":@ID@,"currency":"USD"', '"activityId":@ID@,"currency":"EUR"', False), ("graphql-detail-identity", "booked", '"activityId":"@ID@"', '"activityId":"x"', False),
    ("graphql-selection", "booked", requestlogs.DATE_SOURCE, "calendar", False), ("graphql-price-variables", "booked", '"priceCalendar":[{"variables":{"currency":"USD"', '"priceCalendar":[{"variables":{"currency":"EUR"', False),
    ("graphql-price-query-missing", "booked", '"cancellation":[{', '"refund":[{', False), ("graphql-base-price", "booked", "USD 30", "USD 31", True), ("graphql-booking-date", "booked", "2024-05-06", "2024-05-08", True),
    ("graphql-pax-variables", "booked", '"locale":"en-US","productCode":"C-9","travelDate":"2024-05-04"', '"locale":"hu","productCode":"C-9","travelDate":"2024-05-04"', False),
    ("graphql-pax-dates", "booked", '"pax":[' + _day("2024-05-04", "PENDING") + "," + _day("2024-05-04", "FAILED") + ",", '"pax":[', False),
    ("graphql-pax-date-order", "booked", _day("2024-05-04", "PENDING") + ",", _day("2024-05-04", "PENDING") + "," + _day("2024-05-06", "PENDING") + ",", False),
    ("graphql-pax-date-policy", "booked", requestlogs.DATE_POLICY, "any", False), ("graphql-pax-date-prefix", "booked", '"date":"2024-05-05","price":-1', '"date":"2024-05-05","price":1', False), ("graphql-pax-date-prefix", "booked", '"cutoffHours":30', '"cutoffHours":60', False),
    ("graphql-pax-language-provenance", "booked", '"languages":["en"]', '"languages":["hu"]', False),
    ("graphql-pax-poll-bound", "booked", '"pax":[' + _day("2024-05-04", "PENDING"), '"pax":[' + ",".join([_day("2024-05-04", "PENDING")] * 3), False),
    ("graphql-pax-after-settle", "booked", '"pax":[' + _day("2024-05-04", "PENDING"), '"pax":[' + _day("2024-05-04", "FAILED"), False),
    ("graphql-pax-unsettled", "booked", _day("2024-05-06", "SUCCESS"), _day("2024-05-06", "PENDING"), False), ("graphql-pax-retry-cause", "booked", _day("2024-05-04", "FAILED"), _day("2024-05-04", "SUCCESS"), False),
    ("graphql-pax-provenance", "failed", "pax_failed", "closed", False), ("graphql-pax-failed-state", "failed", '"status":"unknown"', '"status":"available"', True), ("graphql-pax-failed-price", "failed", "USD 30", "", True), ("graphql-travelers", "booked", "2 adults", "2 adults, 1 child", True),
    ("graphql-package-poll-bound", "booked", '"packages":[' + json.dumps(_POLLED[0], separators=(",", ":")), '"packages":[' + ",".join([json.dumps(_POLLED[0], separators=(",", ":"))] * 3), False),
    ("graphql-package-variables", "booked", '"passengerMix":[{"band":"ADULT","count":2}],"currencies":["USD"],"locale":"en-US"}', '"passengerMix":[{"band":"ADULT","count":"2"}],"currencies":["USD"],"locale":"en-US"}', False),
    ("graphql-package-after-settle", "booked", '{"tourGrades":{"resultStatus":"PENDING"', '{"tourGrades":{"resultStatus":"FAILED"', False), ("graphql-package-provenance", "booked", '"packageOptionsStatus":"AVAILABLE"', '"packageOptionsStatus":"UNKNOWN"', False),
    ("graphql-package-count", "booked", ',{"name":"Large tour","total_price":"$95.50"}', "", True), ("graphql-package-name", "booked", '"name":"Large tour"', '"name":"Larger tour"', True), ("graphql-package-price", "booked", "$95.50", "$95.05", True),
]
#: Names of personal fields.
DENIED = ["displayname", "username", "avatarurl"]


def changed(i: int) -> tuple[str, str, str]:
    """(route, evidence, stored) of the i-th change."""
    _, kind, old, new, in_stored = CHANGES[i]
    evidence, stored = _TEXT[kind], _KEPT[kind]
    if in_stored:
        stored = stored.replace(old, new)
    elif old:
        evidence = evidence.replace(old, new)
    return ("venue" if kind == "venue" else "product"), evidence, stored


@query(f"SELECT o_orderkey, code FROM orders JOIN (VALUES {', '.join(f"({i}, '{c[0]}')" for i, c in enumerate(CHANGES) if c[0])}) AS v(i, code) ON o_orderkey % {len(CHANGES)} = i")
def request_log_derived(spark, d):
    """O-Q9: a log for each order, with one change or none; what a query must have follows from the answers before it."""
    changes = spark.createDataFrame([(i, *changed(i)) for i in range(len(CHANGES))], "i long, route string, evidence string, stored string")
    orders = read(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % len(CHANGES)).alias("i"))
    logs = spread(orders).join(F.broadcast(changes), "i")  # one row a change
    own = F.col("o_orderkey").cast("string")
    logs = logs.select("o_orderkey", "route", own.alias("detail_id"), F.replace("evidence", F.lit(ID), own).alias("evidence"), "stored")
    return requestlogs.log_issues(logs, "o_orderkey", DENIED)


@query("""WITH p AS (SELECT page_id, page_id % 11 AS k, html, regexp_matches(lower(html), 'captcha|unusual traffic|verify you are human') AS blocked FROM pages)
    SELECT page_id, code FROM (SELECT page_id, CASE WHEN k = 9 THEN NULL WHEN k = 1 THEN 'fallback-graphql-state' WHEN k = 7 THEN CASE WHEN html IS NOT NULL AND NOT blocked THEN 'fallback-missing' END WHEN k = 2 OR html IS NULL THEN 'fallback-raw-missing' WHEN k = 3 OR blocked THEN 'fallback-raw-invalid'
        WHEN k = 4 THEN 'fallback-identity' WHEN k = 5 THEN 'fallback-pricing' WHEN k = 6 OR k = 10 THEN 'fallback-package-scope' WHEN k = 8 THEN 'fallback-provenance' END AS code FROM p) WHERE code IS NOT NULL""")
def fallback_projection(spark, d):
    """O-Q9: rendered pages that stand in for failed logs; every eleventh page has another fault."""
    k = F.col("page_id") % 11
    pages = read(spark, d, "pages").select("page_id", "url", "html")
    own = identity(F.col("url"))
    reason = F.when(k.isin(1, 9), "").otherwise("tour_grades_failed")
    selections = pages.select("page_id", own.alias("identity"), reason.alias("reason"))
    kind, checked = F.when(~k.isin(7, 9), requestlogs.RENDERED), F.when(k == 8, "2024-04-30").otherwise("2024-05-01")
    canonical = F.when(k == 4, "https://example.com/other/0").otherwise(F.col("url"))
    stored = pages.select("page_id", F.struct(kind.alias("kind"), own.alias("identity"), canonical.alias("canonical_url"), checked.alias("checked_at"), reason.alias("reason")).alias("provenance"))
    html = F.when(k == 2, None).when(k == 3, F.lit("<html>")).otherwise(F.concat(F.lit("<html>" + " " * 1200), "html"))
    text = lambda *without: F.when(~k.isin(*without), "2 adults")
    rendered = pages.select("page_id", html.alias("html"), canonical.alias("canonical_url"), F.lit("2024-05-01").alias("checked_at"), text(5).alias("booking_date"), text(5, 6).alias("travelers"), F.when(k.isin(5, 10), F.array().cast("array<string>")).otherwise(F.array(F.lit("Tour"))).alias("packages"))
    return requestlogs.fallback_issues(selections, stored, rendered, "page_id", least=1200)
