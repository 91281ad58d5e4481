"""Feeds read page by page: ranks, new ids, tail strength and how deep to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayforge.operators.ranking import positioned, running

PAGE, MIN_UNIQUE, MAX_PAGES, TAIL, KEEPERS = 30, 90, 20, 10, 2


def paged(df: DataFrame, feed: str, *order, size: int = PAGE) -> DataFrame:
    """Rows of each feed with pos (from 1) and page (from 0), all of them; no task sees a whole feed."""
    return positioned(df, list(order), (feed,)).withColumnRenamed("position", "pos").withColumn("page", F.floor((F.col("pos") - 1) / size).cast("long"))


def feed_rank(pages: DataFrame, feed: str, identity: str, size: int = PAGE) -> DataFrame:
    """Page offset plus the rank among the page's distinct identities."""
    first = pages.groupBy(feed, "page", identity).agg(F.min("pos").alias("pos"))
    rank = F.row_number().over(Window.partitionBy(feed, "page").orderBy("pos"))
    return first.select(feed, "page", identity, (F.col("page") * size + rank).cast("long").alias("rank"))


def new_ids(pages: DataFrame, feed: str, identity: str) -> DataFrame:
    """(feed, page, rows, new, unique_so_far)."""
    first = pages.groupBy(feed, identity).agg(F.min(F.struct("pos", "page")).alias("_f")).groupBy(feed, F.col("_f.page").alias("page")).agg(F.count("*").alias("_new"))
    per = pages.groupBy(feed, "page").agg(F.count("*").alias("rows")).join(first, [feed, "page"], "left").withColumn("new", F.coalesce("_new", F.lit(0).cast("long")))
    return running(per, [feed], "page", {"unique_so_far": F.col("new")}).select(feed, "page", "rows", "new", "unique_so_far")


def tail_strength(pages: DataFrame, feed: str, strong: Column, tail: int = TAIL) -> DataFrame:
    """(feed, page, strong): strong rows among the page's last ones."""
    back = pages.withColumn("_back", F.row_number().over(Window.partitionBy(feed, "page").orderBy(F.desc("pos"))))
    return back.where(F.col("_back") <= tail).groupBy(feed, "page").agg(F.count_if(strong).alias("strong"))


def depth_decision(pages: DataFrame, feed: str, cap: int = MAX_PAGES, least: int = MIN_UNIQUE, keepers: int = KEEPERS) -> DataFrame:
    """pages: (feed, page, new, unique_so_far, strong). The first rule that holds decides for each page."""
    last = pages.groupBy(feed).agg(F.max("page").alias("_last"))
    has_next = F.col("page") < F.col("_last")
    decision = (
        F.when(~has_next, "stop: last page").when(F.col("new") == 0, "stop: no new ids").when(F.col("page") + 1 >= cap, "stop: page cap")
        .when(F.col("unique_so_far") < least, "go: too few").when(F.col("strong") >= keepers, "go: strong tail").otherwise("stop: weak tail")
    )
    return pages.join(last, feed).withColumn("decision", decision).drop("_last")


def stop_pages(decided: DataFrame, feed: str) -> DataFrame:
    return decided.where(F.col("decision").startswith("stop")).groupBy(feed).agg(F.min("page").alias("stop_page"))


def weak_streaks(decided: DataFrame, feed: str) -> DataFrame:
    """The number of weak tails in a row up to each page; any other page resets it."""
    weak = F.col("decision") == "stop: weak tail"
    # weak tails so far, less those up to the last page that is none
    counted = running(decided, [feed], "page", {"_weak": F.when(weak, 1).otherwise(0)})
    last = running(counted, [feed], "page", {}, {"_reset": F.when(~weak, F.col("_weak"))})
    streak = (F.col("_weak") - F.coalesce("_reset", F.lit(0))).cast("long")
    return last.withColumn("streak", streak).withColumn("stop", F.col("streak") >= 2).drop("_weak", "_reset")


def first_wins(pages: DataFrame, identity: str, feed: str) -> DataFrame:
    """One row an identity: that of the first feed (by name), and there of the best place."""
    w = Window.partitionBy(identity).orderBy(feed, "pos")
    return pages.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def memberships(pages: DataFrame, identity: str, feed: str) -> DataFrame:
    """(identity, primary, also): the first feed, then the others once each in order of appearance."""
    each = pages.groupBy(identity, feed).agg(F.min("pos").alias("pos"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(feed, "pos"))), lambda x: x[feed])
    return each.groupBy(identity).agg(ordered.alias("_all")).select(identity, F.col("_all")[0].alias("primary"), F.expr("slice(_all, 2, size(_all))").alias("also"))
