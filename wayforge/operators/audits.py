"""Audits: each gives (key, code), one row a broken rule."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayforge.operators.textjobs import issues

#: The fields in which an inventory row and its evidence must agree.
METADATA = ("city", "name", "url", "category", "subtype", "rating", "review_count", "route", "id", "key")


def domain_issues(rows: DataFrame, key: str, rating: str | None = None, review_rating: str | None = None, reviews: str | None = None) -> DataFrame:
    """Ratings of listings within 0 to 5, of reviews within 1 to 5, both finite, and counts that are not negative."""
    off = lambda c, low: F.isnan(c) | ~F.col(c).between(low, 5)
    rules = {}
    if rating:
        rules["listing-rating"] = off(rating, 0)
    if review_rating:
        rules["review-rating"] = F.col(review_rating).isNull() | off(review_rating, 1)
    if reviews:
        rules["listing-review-count"] = F.col(reviews).isNull() | (F.col(reviews) < 0)
    return issues(rows, key, rules)


def identity_issues(rows: DataFrame, key: str, inventory: str, stored: str, canonical: str, identity, hosts: str) -> DataFrame:
    """The inventory's, the stored and the canonical address name the same page, and the canonical host is allowed.

    identity makes a key of an address, 'url:...' if it has none; hosts is a pattern for the end of a host."""
    from wayforge.sources.pages import host

    a, b, c = (identity(F.col(x)) for x in (inventory, stored, canonical))
    return issues(rows, key, {"inventory-identity": a.startswith("url:"), "stored-identity": b != a, "canonical-identity": F.coalesce(c != a, F.lit(True)), "canonical-host": ~F.coalesce(host(F.col(canonical)).rlike(hosts), F.lit(False))})


def review_issues(reviews: DataFrame, key: str, most: int = 10) -> DataFrame:
    """reviews (title, text, rating): at most so many, none empty, none twice, each with a rating from 1 to 5."""
    empty = (F.coalesce("title", F.lit("")) == "") & (F.coalesce("text", F.lit("")) == "")
    bad = F.col("rating").isNull() | ~F.col("rating").between(1, 5)
    each = reviews.groupBy(key, F.xxhash64("title", "text").alias("_same"), "title", "text").agg(F.count("*").alias("_n"), F.bool_or(bad).alias("_bad")).withColumn("_empty", empty)
    per = each.groupBy(key).agg(F.sum("_n").alias("_n"), F.max("_n").alias("_m"), F.bool_or("_empty").alias("_e"), F.bool_or("_bad").alias("_b"))
    return issues(per, key, {"reviews-limit": F.col("_n") > most, "review-empty": F.col("_e"), "review-duplicate": F.col("_m") > 1, "review-rating": F.col("_b")})


def coverage(rows: DataFrame, key: str, shown: list[str], discovered: str, unique: str, most: int = 10) -> DataFrame:
    """(key, target, got, covered): the total is the largest that the page shows, else the discovered one; so many unique
    reviews, at most ``most``, are needed."""
    total = F.coalesce(F.greatest(*(F.col(c) for c in shown)) if len(shown) > 1 else F.col(shown[0]), F.col(discovered), F.lit(0))
    target = F.least(F.lit(most), total)
    return rows.select(key, target.alias("target"), F.col(unique).alias("got"), (F.col(unique) >= target).alias("covered"))


def coverage_issues(rows: DataFrame, key: str, excused: DataFrame) -> DataFrame:
    """rows (covered, languages, all_languages, filter): too few reviews unless the key is excused, a language scope that
    is missing or not all languages, or a filter left on."""
    out = rows.join(excused.select(key, F.lit(True).alias("_excused")), key, "left")
    return issues(out, key, {
        "review-coverage": ~F.col("covered") & F.col("_excused").isNull(), "review-language-missing": F.col("languages").isNull(), "review-language": F.col("languages").isNotNull() & ~F.col("all_languages"), "review-filter": F.coalesce(F.col("filter"), F.lit("")) != "",
    })


def request_log_issues(attempts: DataFrame, contract: DataFrame, key: str, settled: tuple[str, ...] = ("SUCCESS", "FAILED")) -> DataFrame:
    """(key, query, code) of request logs against a contract.

    attempts: (key, query, at, ordinal, query_id, http, variables, status, has_data), in the order of ``at``; contract:
    (query, query_id, variables, most, required), a parameter of a few rows; variables of null are free. Codes: missing,
    unexpected, attempt-order, query-id, http, variables, response, polls, after-settle."""
    w = Window.partitionBy(key, "query").orderBy("at")
    a = attempts.withColumns({"_rn": F.row_number().over(w), "_settled": F.max(F.when(F.col("status").isin(*settled), 1)).over(w.rowsBetween(Window.unboundedPreceding, -1))})
    c = contract.select("query", F.col("query_id").alias("_id"), F.col("variables").alias("_variables"), F.col("most").alias("_most"), F.lit(True).alias("_known"))
    a = a.join(F.broadcast(c), "query", "left")  # the contract is a parameter
    rules = {
        "graphql-query-unexpected": F.col("_known").isNull() & (F.col("_rn") == 1), "graphql-attempt-order": ~F.col("ordinal").eqNullSafe(F.col("_rn")), "graphql-query-id": F.col("_known") & ~F.col("query_id").eqNullSafe(F.col("_id")),
        "graphql-http": ~F.col("http").eqNullSafe(F.lit(200)), "graphql-variables": F.col("variables").isNull() | (F.col("_variables").isNotNull() & (F.col("variables") != F.col("_variables"))), "graphql-response": ~F.coalesce("has_data", F.lit(False)),
        "graphql-polls": F.col("_rn") == F.col("_most") + 1, "graphql-after-settle": F.col("_settled").isNotNull(),
    }
    found = F.explode(F.array_compact(F.array(*(F.when(F.coalesce(t, F.lit(False)), F.lit(code)) for code, t in rules.items())))).alias("code")
    wrong = a.select(key, "query", found)
    wanted = contract.where("required").agg(F.collect_list("query").alias("_wanted"))
    have = attempts.groupBy(key).agg(F.collect_set("query").alias("_have")).join(F.broadcast(wanted))  # one row; a log has a few queries
    missing = have.select(key, F.explode(F.array_except("_wanted", "_have")).alias("query"), F.lit("graphql-query-missing").alias("code"))
    return wrong.union(missing)


def attempt_order(attempts: DataFrame, key: str, at: str, ordinal: Column, settled: Column) -> DataFrame:
    """(key, numbered, after_settled): whether attempts are numbered without gaps from the first, and whether one follows a
    settled one."""
    w = Window.partitionBy(key).orderBy(at)
    seen = attempts.select(key, (ordinal == F.row_number().over(w)).alias("_ok"), F.lag(settled).over(w).alias("_last"))
    return seen.groupBy(key).agg(F.bool_and("_ok").alias("numbered"), F.coalesce(F.bool_or("_last"), F.lit(False)).alias("after_settled"))


def attempted_prefix(rows: DataFrame, key: str, date: str, attempted: str) -> DataFrame:
    """(key, k, is_prefix): whether the attempted dates are the first of those advertised; rows (date, attempted), a date
    once or more. No list is collected: no date that was left out may lie before the last attempted one."""
    each = rows.groupBy(key, date).agg(F.bool_or(attempted).alias("_a"))
    per = each.groupBy(key).agg(F.count_if("_a").alias("k"), F.max(F.when(F.col("_a"), F.col(date))).alias("_last"), F.min(F.when(~F.col("_a"), F.col(date))).alias("_out"))
    return per.select(key, "k", F.coalesce(F.col("_last") < F.col("_out"), F.lit(True)).alias("is_prefix"))


def earliest_dates(rows: DataFrame, key: str, date: str, price: Column, checked: Column, cutoff_hours: Column, most: int = 5) -> DataFrame:
    """(key, day, rank): the first dates with a price of zero or more, each once, from max(1, ceil(hours / 24) + 1) days
    after the check on."""
    lead = F.greatest(F.lit(1), F.ceil(F.greatest(F.coalesce(cutoff_hours, F.lit(0)), F.lit(0)) / 24) + 1).cast("int")
    dates = rows.where((F.col(date) >= F.date_add(checked, lead)) & (price >= 0)).select(key, F.col(date).alias("day")).distinct()
    return dates.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("day"))).where(F.col("rank") <= most)


def stale_derivations(rows: DataFrame, key: str, derived: dict[str, Column]) -> DataFrame:
    """Stored fields that are not what today's code derives."""
    return rows.where(functools.reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(now) for c, now in derived.items()))).select(key, F.lit("stale-parse").alias("code"))


#: What briefs and prices may hold.
PRICE_STATES = ("available", "priced", "free", "date-required", "not-published", "unavailable")
KINDS = ("exact", "from", "range", "free", "date-required")


def publication_issues(records: DataFrame, packages: DataFrame, key: str) -> DataFrame:
    """records (what, do, why, summary, source, checked_at, provenance, status, starting, currency) and packages (key,
    kind, amount, availability) of a publication: texts present and not too long, HTTPS sources, dates, known states,
    amounts of money, and states that agree with packages."""
    from wayforge.operators.textjobs import CAPS

    rules = {f"brief-{c}": F.coalesce(F.trim(c) == "", F.lit(True)) for c in ("what", "do", "why")} | {f"brief-{c}-length": F.length(c) > most for c, most in CAPS.items()}
    money = r"^(?:0|[1-9][0-9]{0,8})(?:\.[0-9]{1,2})?$"
    rules |= {
        "source": ~F.coalesce(F.col("source").rlike("^https://"), F.lit(False)), "checked-at": F.try_to_date("checked_at", "yyyy-MM-dd").isNull(), "provenance": ~F.coalesce(F.col("provenance").isin("generated", "curated"), F.lit(False)),
        "price-status": ~F.coalesce(F.col("status").isin(*PRICE_STATES), F.lit(False)), "starting-price": F.col("starting").isNotNull() & (~F.col("starting").rlike(money) | F.col("currency").isNull()), "starting-unpriced": F.col("starting").isNotNull() & (F.col("status") != "priced"),
    }
    package_rules = {"package-kind": ~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)), "package-amount": F.col("kind").isin("exact", "from", "range") & ~F.coalesce(F.col("amount").rlike(money), F.lit(False))}
    per = packages.groupBy(key).agg(F.bool_or(F.col("availability") == "available").alias("_some"), F.bool_or(F.col("kind") == "free").alias("_free"), F.count("*").alias("_n"))
    both = records.select(key, "status").join(per, key, "left")
    against = {"status-packages": (F.col("status") == "unavailable") & F.col("_some"), "status-free": (F.col("status") == "free") & ~F.coalesce("_free", F.lit(False)), "status-not-published": (F.col("status") == "not-published") & (F.col("_n") > 0)}
    return issues(records, key, rules).union(issues(packages, key, package_rules)).union(issues(both, key, against)).distinct()


def namespace_issues(rows: DataFrame, key: str, reserved: str, id_: str, raw: list[str]) -> DataFrame:
    """Reserved prefixes of keys, ids that are not safe, and raw text (columns that must be null) that must not ship."""
    rules = {"reserved": F.col(key).startswith(reserved), "unsafe-id": ~F.coalesce(F.col(id_).rlike(r"^[A-Za-z0-9][A-Za-z0-9._:#-]*$"), F.lit(False)) | F.col(id_).isin("__proto__", "constructor", "prototype")}
    return issues(rows, key, rules | {f"raw-{c}": F.col(c).isNotNull() for c in raw})


def completeness_issues(rows: DataFrame, key: str, texts: list[str], enums: dict[str, tuple], lists: list[str], sources: str | None = None, least: int = 2) -> DataFrame:
    """Texts longer than ``least``, known values, lists without repeated members, HTTPS sources, and unique keys."""
    rules = {f"short-{c}": F.coalesce(F.length(F.trim(c)), F.lit(0)) <= least for c in texts} | {f"enum-{c}": ~F.coalesce(F.col(c).isin(*v), F.lit(False)) for c, v in enums.items()}
    rules |= {f"list-{c}": F.size(F.array_distinct(c)) != F.size(c) for c in lists}
    if sources:
        rules["source"] = F.exists(sources, lambda x: ~x.startswith("https://"))
    twice = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key, F.lit("duplicate-id").alias("code"))
    return issues(rows, key, rules).union(twice)
