"""Multi-source merges with precedence, coverage and ageing.

Sources are tables of slots ``venue, item, date, time``.  A venue's control row
says which source to trust: ``status`` (official, unreachable, none), the covered
range ``cf`` to ``ct``, whether the secondary source was ``fetched``, the previous
run's ``prev_prelim`` date, the ``confirmed_to`` date and whether its kept rows are ``expired``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CELL = ["venue", "item", "date"]


def in_window(df: DataFrame, floor: str, end: str) -> DataFrame:
    return df.filter(F.col("date").between(F.lit(floor).cast("date"), F.lit(end).cast("date")))


def cells(slots: DataFrame, keys: list[str] = CELL, value: str = "time") -> DataFrame:
    """One row a cell, its distinct values sorted."""
    return slots.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(value)), ",").alias("times"))


def _tagged(slots: DataFrame, venues: DataFrame, floor: str, end: str) -> DataFrame:
    # a row a venue on the other side: small and broadcast by its measured size
    return in_window(slots, floor, end).join(venues, "venue")


def authoritative_merge(official: DataFrame, secondary: DataFrame, previous: DataFrame, venues: DataFrame, floor: str, end: str) -> tuple[DataFrame, DataFrame]:
    """(slots with source, log of what was not taken).

    official: its rows inside coverage are the whole truth, later ones are
    extras, earlier ones are dropped; after coverage the secondary source (or,
    unfetched, the previous run) adds cells that no extra has; before coverage
    the previous run's confirmed rows stay.  unreachable: the previous rows
    stay until expired, the secondary source adds dates without any, after the
    confirmed date.  none: the secondary source, or unfetched the unexpired
    previous run.
    """
    o, s, p = (_tagged(x, venues, floor, end) for x in (official, secondary, previous))
    own = o.filter((F.col("status") == "official") & (F.col("date") >= F.col("cf"))).withColumn("source", F.lit("official"))
    extra = own.filter(F.col("date") > F.col("ct")).select(*CELL).distinct()
    after = s.filter((F.col("status") == "official") & F.col("fetched") & (F.col("date") > F.col("ct"))).withColumn("source", F.lit("secondary"))
    after = after.unionByName(p.filter((F.col("status") == "official") & ~F.col("fetched") & (F.col("date") > F.col("ct"))).withColumn("source", F.lit("previous")))
    after = after.join(extra, CELL, "left_anti")
    before = p.filter((F.col("status") == "official") & (F.col("cf") > F.lit(floor).cast("date")) & (F.col("date") < F.col("cf")) & (F.col("date") < F.col("prev_prelim"))).withColumn("source", F.lit("previous"))

    kept = p.filter((F.col("status") == "unreachable") & ~F.col("expired")).withColumn("source", F.lit("previous"))
    dates = kept.select("venue", "date").distinct()
    late = s.filter((F.col("status") == "unreachable") & (F.col("expired") | (F.col("date") > F.col("confirmed_to"))))
    late = late.join(dates, ["venue", "date"], "left_anti").withColumn("source", F.lit("secondary"))

    alone = s.filter((F.col("status") == "none") & F.col("fetched")).withColumn("source", F.lit("secondary"))
    stale = p.filter((F.col("status") == "none") & ~F.col("fetched") & ~F.col("expired")).withColumn("source", F.lit("previous"))
    out = [*CELL, "time", "source", "status"]
    rows = own.select(*out)
    for x in (after, before, kept, late, alone, stale):
        rows = rows.unionByName(x.select(*out))

    inside = s.filter((F.col("status") == "official") & F.col("date").between(F.col("cf"), F.col("ct")))
    discarded = inside.join(own.select(*CELL, "time"), [*CELL, "time"], "left_anti").select(*CELL, "time", F.lit("discarded").alias("reason"))
    there = kept.select(*CELL, F.lit(1).alias("kept")).distinct()
    clash = s.filter("status = 'unreachable'").join(there, CELL).join(kept.select(*CELL, "time"), [*CELL, "time"], "left_anti")
    log = discarded.unionByName(clash.select(*CELL, "time", F.lit("kept row wins").alias("reason")))
    return rows.distinct(), log.distinct()


def prelim_from(venues: DataFrame, floor: str) -> DataFrame:
    """The first date that isn't confirmed, by venue."""
    return venues.select("venue", F.when(F.col("status") == "official", F.date_add("ct", 1)).otherwise(F.lit(floor).cast("date")).alias("prelim_from"))


def first_writer_merge(sources: list[DataFrame], excluded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of sources in order of trust, the first for each key; excluded keys block all but the first source."""
    rows = None
    for rank, x in enumerate(sources):
        x = x.join(excluded.select(*keys).distinct(), keys, "left_anti") if rank else x
        x = x.withColumn("rank", F.lit(rank))
        rows = x if rows is None else rows.unionByName(x)
    rest = [c for c in rows.columns if c not in (*keys, "rank")]
    return rows.groupBy(*keys).agg(F.min(F.struct("rank", *rest)).alias("x")).select(*keys, "x.*")


def overlay(rows: DataFrame, base: DataFrame, prelim: DataFrame) -> DataFrame:
    """Overlay rows as listed, contradicted or added, and whether an added one is preliminary."""
    same = base.select(*CELL, "time", F.lit(1).alias("same")).distinct()
    day = base.select(*CELL, F.lit(1).alias("day")).distinct()
    d = rows.select(*CELL, "time").distinct().join(same, [*CELL, "time"], "left").join(day, CELL, "left").join(prelim, "venue", "left")
    outcome = F.when(F.col("same") == 1, "listed").when(F.col("day") == 1, "contradicted").otherwise("added")
    flag = F.when(outcome == "added", F.coalesce(F.col("date") < F.col("prelim_from"), F.lit(False)))
    return d.select(*CELL, "time", outcome.alias("outcome"), flag.alias("row_prelim"))


def reconcile_passes(left: DataFrame, right: DataFrame, passes: list[list[str]], left_id: str, right_id: str) -> DataFrame:
    """One-to-one pairs in passes of ever looser keys, each over what is still unpaired.

    Within a key the n-th left row (by id) pairs with the n-th right one, so a
    hot key costs its rows and never their product.
    """
    out = None
    for number, keys in enumerate(passes, 1):
        a = left.withColumn("n", F.row_number().over(W.partitionBy(*keys).orderBy(left_id)))
        b = right.withColumn("n", F.row_number().over(W.partitionBy(*keys).orderBy(right_id)))
        pairs = a.select(*keys, "n", left_id).join(b.select(*keys, "n", right_id), [*keys, "n"]).select(left_id, right_id, F.lit(number).alias("pass"))
        out = pairs if out is None else out.unionByName(pairs)
        left, right = left.join(pairs.select(left_id), left_id, "left_anti"), right.join(pairs.select(right_id), right_id, "left_anti")
    return out


def rehome(rows: DataFrame, host: DataFrame, moves: DataFrame) -> DataFrame:
    """Rows moved to moves' host (venue, host) unless the host lists the same slot."""
    d = rows.join(moves, "venue", "inner").withColumn("from_venue", F.col("venue")).withColumn("venue", F.col("host")).drop("host")
    return d.join(host.select(*CELL, "time").distinct(), [*CELL, "time"], "left_anti").select("from_venue", *CELL, "time")


def relocate(slots: DataFrame, moves: DataFrame) -> DataFrame:
    """Cells after moves (venue, item, dst): the moved venue if there is one."""
    return cells(slots.join(moves, ["venue", "item"], "left").withColumn("venue", F.coalesce("dst", "venue")).drop("dst"))


def nearest_within(left: DataFrame, right: DataFrame, keys: list[str], minute: str, most: int, left_id: str, right_id: str) -> DataFrame:
    """The nearest right row within most minutes of each left row, by equal keys; ties to the earlier, then the id.

    Minutes are bucketed by most, so that a row meets three buckets and not its whole key.
    """
    r = right.select(*keys, F.explode(F.sequence(F.floor(F.col(minute) / most) - 1, F.floor(F.col(minute) / most) + 1)).alias("bucket"), F.col(minute).alias("there"), right_id)
    d = left.select(*keys, F.floor(F.col(minute) / most).alias("bucket"), F.col(minute).alias("here"), left_id).join(r, [*keys, "bucket"])
    gap = F.abs(F.col("here") - F.col("there"))
    return d.filter(gap <= most).groupBy(left_id).agg(F.min(F.struct(gap.alias("gap"), "there", right_id)).alias("x")).select(left_id, f"x.{right_id}", "x.gap")


def unique_links(pairs: DataFrame, key: str, url: str) -> DataFrame:
    """Pairs whose key has one url and whose url has one key."""
    d = pairs.select(key, url).distinct()
    one_url = d.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(url).alias(url)).filter("n = 1").select(key, url)
    one_key = d.groupBy(url).agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select(url)
    return one_url.join(one_key, url).select(key, url)


def keep_previous(previous: DataFrame, fresh: DataFrame, key: str, value: str, misses: str, most: int) -> DataFrame:
    """Fresh rows, and previous ones that missed fewer than most runs in a row."""
    d = previous.select(key, F.col(value).alias("old"), F.col(misses).alias("m")).join(fresh.select(key, F.col(value).alias("new"), F.lit(True).alias("seen")), key, "full")
    count = F.when(F.col("seen"), F.lit(0)).otherwise(F.col("m") + 1)
    return d.select(key, F.coalesce("new", "old").alias(value), count.cast("long").alias(misses)).filter(F.col(misses) < most)


def fill_empty(catalogue: DataFrame, facts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Every key of both; a column of the catalogue is filled only where it is null or empty."""
    a = catalogue.select(key, *[F.col(c).alias(f"a_{c}") for c in columns])
    b = facts.select(key, *[F.col(c).alias(f"b_{c}") for c in columns])

    def filled(c: str) -> Column:
        return F.coalesce(F.nullif(F.col(f"a_{c}"), F.lit("")), F.col(f"b_{c}")).alias(c)

    return a.join(b, key, "full").select(key, *[filled(c) for c in columns])


def membership(events: DataFrame, items: DataFrame, slots: DataFrame) -> DataFrame:
    """(event, item): an event's title is one item's alone, and that item has a slot inside the event's dates at its venue."""
    one = items.groupBy("title").agg(F.count(F.lit(1)).alias("n"), F.min("item").alias("item")).filter("n = 1").select("title", "item")
    e = events.select("event", "venue", "from_date", "to_date", F.explode("titles").alias("title")).join(one, "title")
    s = slots.select("venue", "item", "date").distinct()
    return e.join(s, ["venue", "item"]).filter(F.col("date").between(F.col("from_date"), F.col("to_date"))).select("event", "item").distinct()


def confirmed_days(official: DataFrame, secondary: DataFrame) -> DataFrame:
    """Days of a venue on which the secondary source adds nothing to the official one."""
    more = secondary.select(*CELL, "time").join(official.select(*CELL, "time"), [*CELL, "time"], "left_anti").select("venue", "date").distinct()
    return official.select("venue", "date").distinct().join(more, ["venue", "date"], "left_anti")


def misplaced_links(links: DataFrame) -> DataFrame:
    """Links whose url another venue has too, by count instead of a self join."""
    many = links.groupBy("url").agg(F.count_distinct("venue").alias("venues")).filter("venues > 1")
    return links.join(many, "url")
