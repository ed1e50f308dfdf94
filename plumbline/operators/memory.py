"""State between runs: read outcomes, remembered days, attributes carried over, caches and misses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEEP_DAYS, BACK, AHEAD = 14, 35, 7


def record_reads(state: DataFrame, reads: DataFrame, today: str) -> DataFrame:
    """venue, last_ok, covered_to, failing_since, last_error after a run; reads: venue, ok, covered_to, error.

    A good read clears a failure; a failed one keeps what was known and dates the failure from the first one.
    """
    t = F.lit(today).cast("date")
    d = state.select("venue", "last_ok", F.col("covered_to").alias("old_to"), "failing_since", "last_error").join(reads.select("venue", "ok", F.col("covered_to").alias("new_to"), "error"), "venue", "full")
    ok, bad = F.coalesce("ok", F.lit(False)), ~F.coalesce("ok", F.lit(True))
    return d.select(
        "venue",
        F.when(ok, t).otherwise(F.col("last_ok")).alias("last_ok"),
        F.when(ok, F.col("new_to")).otherwise(F.col("old_to")).alias("covered_to"),
        F.when(ok, None).when(bad, F.coalesce("failing_since", t)).otherwise(F.col("failing_since")).alias("failing_since"),
        F.when(ok, None).when(bad, F.substring(F.coalesce("error", F.lit("not read")), 1, 300)).otherwise(F.col("last_error")).alias("last_error"),
    )


def remember_days(old: DataFrame, page: DataFrame, until: DataFrame, today: str, back: int = BACK, ahead: int = AHEAD) -> DataFrame:
    """venue, date, time, stage: what was listed on remembered days.

    Days from today to ahead days on, or to the venue's until, are replaced by the page's rows; earlier
    ones stay as last recorded, back days far.
    """
    t = F.lit(today).cast("date")
    past = old.join(until.select("venue"), "venue", "left_semi").filter((F.col("date") < t) & (F.col("date") >= F.date_sub(t, back)))
    rest = old.join(until.select("venue"), "venue", "left_anti").filter(F.col("date") >= F.date_sub(t, back))
    new = page.join(until, "venue").filter((F.col("date") >= t) & (F.col("date") <= F.least(F.date_add(t, ahead), F.coalesce("until", F.date_add(t, ahead))))).drop("until")
    cols = ["venue", "date", "time", "stage"]
    return past.select(*cols).unionByName(new.select(*cols)).unionByName(rest.select(*cols)).distinct()


def carry_attributes(store: DataFrame, rows: DataFrame, today: str, keep: int = KEEP_DAYS) -> DataFrame:
    """Rows with the hall that an earlier read gave, where they name none: store is venue, read, date, time, show, hall.

    What was read more than keep days ago, and what lies in the past, is forgotten.
    """
    t = F.lit(today).cast("date")
    s = store.filter((F.datediff(t, "read") <= keep) & (F.col("date") >= t) & F.col("hall").isNotNull())
    s = s.groupBy("venue", "date", "time", "show").agg(F.max_by("hall", F.struct("read", "hall")).alias("was"))
    return rows.join(s, ["venue", "date", "time", "show"], "left").withColumn("hall", F.coalesce("hall", "was")).drop("was")


def kept_policy(state: DataFrame, today: str, keep: int = KEEP_DAYS) -> DataFrame:
    """venue, since, age, expired, confirmed_to of what may be kept; state: venue, last_ok, covered_to, failing_since, prev_prelim."""
    t = F.lit(today).cast("date")
    since = F.coalesce("last_ok", "failing_since", t)
    confirmed = F.when(F.col("last_ok").isNotNull(), F.col("covered_to")).otherwise(F.date_sub("prev_prelim", 1))
    return state.select("venue", since.alias("since"), F.datediff(t, since).alias("age"), (F.datediff(t, since) > keep).alias("expired"), confirmed.alias("confirmed_to"))


def backward_run(days: DataFrame, today: str) -> DataFrame:
    """venue, first, days: the known days that run back from yesterday without a gap."""
    t = F.lit(today).cast("date")
    d = days.select("venue", "date").distinct().filter(F.col("date") < t)
    d = d.withColumn("gap", F.datediff(t, "date") - F.row_number().over(W.partitionBy("venue").orderBy(F.desc("date")))).filter("gap = 0")
    return d.groupBy("venue").agg(F.min("date").alias("first"), F.count(F.lit(1)).alias("days"))


def record_misses(state: DataFrame, misses: DataFrame, today: str) -> DataFrame:
    """A page that gave nothing is noted; a text read earlier stays: state is id, source, url, text, tried, own_url, own_tried; misses id, source, url."""
    t = F.lit(today).cast("date")
    m = misses.select("id", F.col("source").alias("ms"), F.col("url").alias("mu"))
    d = state.join(m, "id", "full")
    hit, good = F.col("mu").isNotNull(), F.coalesce("text", F.lit("")) != ""
    same = (F.col("url") == F.col("mu")) & (F.col("source") == F.col("ms"))
    own = hit & good & ~F.coalesce(same, F.lit(False))
    return d.select(
        "id", F.when(hit & ~good, F.col("ms")).otherwise(F.col("source")).alias("source"), F.when(hit & ~good, F.col("mu")).otherwise(F.col("url")).alias("url"), F.when(good, F.col("text")).alias("text"),
        F.when(hit & ~own, t).otherwise(F.col("tried")).alias("tried"), F.when(own, F.col("mu")).otherwise(F.col("own_url")).alias("own_url"), F.when(own, t).otherwise(F.col("own_tried")).alias("own_tried"))


def name_lookups(people: DataFrame, cache: DataFrame, today: str, recheck: int = 30, most: int = 600) -> DataFrame:
    """name: who to look up this run, at most most: never asked first, then those without an answer for recheck days, the longest first."""
    t = F.lit(today).cast("date")
    d = people.select("name").distinct().join(cache, "name", "left")
    due = F.col("asked").isNull() | (F.col("answer").isNull() & (F.datediff(t, "asked") >= recheck))
    return d.filter(due).orderBy(F.col("asked").asc_nulls_first(), "name").limit(most).select("name")


def due_again(state: DataFrame, today: str, recheck: int, retry: int, route: str) -> DataFrame:
    """id, due: whether to read a page now, when a fill and a miss are looked at anew by their own clocks and another route's record counts only for its note of this page.

    state: id, url, rec_url, rec_source, text, fetched, tried, own_url, own_tried; rec_url null: no record.
    """
    t = F.lit(today).cast("date")
    other = ~F.coalesce((F.col("rec_url") == F.col("url")) & (F.col("rec_source") == route), F.lit(False))
    noted = F.coalesce((F.col("own_url") == F.col("url")) & (F.datediff(t, "own_tried") < retry), F.lit(False))
    fill = F.coalesce(F.datediff(t, "fetched") >= recheck, F.lit(True)) & (F.col("fetched").isNull() | F.coalesce(F.datediff(t, "tried") >= retry, F.lit(True)))
    miss = F.coalesce(F.datediff(t, "tried") >= retry, F.lit(True))
    due = F.when(F.col("rec_url").isNull(), True).when(other, ~noted).when(F.coalesce("text", F.lit("")) != "", fill).otherwise(miss)
    return state.select("id", due.alias("due"))


def retry_schedule(wanted: DataFrame, today: str, daily: int = 21, every: int = 7) -> DataFrame:
    """id, due: a missing picture is tried daily for a while, then every so many days, and at once when its link changed."""
    t = F.lit(today).cast("date")
    age = F.coalesce(F.datediff(t, "first_missing"), F.lit(0))
    due = (age <= daily) | F.col("last_try").isNull() | (F.datediff(t, "last_try") >= every) | ~F.col("link").eqNullSafe(F.col("tried_link"))
    return wanted.select("id", due.alias("due"))


def fill_choice(shows: DataFrame, thin: int = 280, least: int = 120) -> DataFrame:
    """id, text, source of a synopsis: owner's, else a fill that replaces a thinner text or its own earlier version, else what stands.

    shows: id, text, owner, fill, fill_source, earlier.
    """
    def size(c: str):
        return F.length(F.trim(F.coalesce(F.col(c), F.lit(""))))

    fits = (size("fill") >= least) & ((F.col("text") == F.col("fill")) | F.coalesce(F.col("text") == F.col("earlier"), F.lit(False)) | ((size("text") < thin) & (size("fill") > size("text"))))
    fits = F.coalesce(fits, (size("fill") >= least) & (size("text") == 0))
    has = size("owner") > 0
    return shows.select("id", F.when(has, F.trim("owner")).when(fits, F.col("fill")).otherwise(F.col("text")).alias("text"), F.when(has, "owner").when(fits, F.col("fill_source")).otherwise("seed").alias("source"))


def pending_plan(texts: DataFrame, cache: DataFrame, pending: DataFrame, today: str, limit: int) -> DataFrame:
    """key, since, chars, allowed: missing texts, the longest missing first, until limit characters; the first always goes.

    A running total by blocks of days: a day's texts are ranked in its own window, and days are few.
    """
    d = texts.groupBy("key").agg(F.min("position").alias("position"), F.first("chars").alias("chars")).join(cache.select("key"), "key", "left_anti")
    d = d.join(pending, "key", "left").withColumn("since", F.coalesce("since", F.lit(today).cast("date")))
    day = d.groupBy("since").agg(F.sum("chars").alias("c")).withColumn("before", F.coalesce(F.sum("c").over(W.orderBy("since").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("c")
    w = W.partitionBy("since").orderBy("position")
    d = d.join(F.broadcast(day), "since").withColumn("total", F.col("before") + F.sum("chars").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return d.select("key", "since", "chars", ((F.col("total") <= limit) | (F.col("total") == F.col("chars"))).alias("allowed"))


def isolated(primary: DataFrame, fallback: DataFrame, check: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(rows, problems): every venue's primary rows, or the fallback's where the check finds a problem.

    primary and fallback are tables of all venues and check gives venue, problem; one bad venue costs itself alone.
    """
    bad = check(primary)
    names = bad.select("venue").distinct()
    return primary.join(names, "venue", "left_anti").unionByName(fallback.join(names, "venue", "left_semi")), bad


def baseline(previous: DataFrame, now: DataFrame, passed: bool, decay: float = 0.5) -> DataFrame:
    """kind, baseline: the best share seen, lowered by decay on a run that passed; runs with too few titles don't move it.

    previous: kind, baseline.  now: kind, n, covered, least.
    """
    d = previous.join(now, "kind", "full")
    pct = F.when((F.col("n") >= F.col("least")) & (F.col("n") > 0), 100.0 * F.col("covered") / F.col("n"))
    old = F.when(pct.isNotNull() & F.lit(passed), F.col("baseline") - decay).otherwise(F.col("baseline"))
    return d.select("kind", F.round(F.greatest(old, pct), 2).alias("baseline")).filter("baseline is not null")
