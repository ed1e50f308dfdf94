"""Events and festivals: one event from several posts, festival rows over venue rows, ranks and credits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.operators import graph
from plumbline.operators.scan import running

BUCKET = 32
#: ids of a unit, about: events of equal words and dates
UNIT = 1_000


def same_event_pairs(events: DataFrame, generic: list[str], shared: int = 6) -> DataFrame:
    """Pairs (a, b) whose dates overlap and of which one's title words hold the other's, or that share a long word.

    events: id, words (array), first, last.  Events of equal words and dates are one unit (of about UNIT ids at most),
    so the comparisons are of units.  Units meet at a word they share and a BUCKET-day stretch both touch, so no pair
    without either is compared; each is found once, at its first long word and in the first stretch, and gives the
    pairs of its ids.
    """
    words = F.array_sort(F.array_distinct(F.filter("words", lambda w: ~w.isin(*generic) & (F.length(w) >= 2) & ~F.rlike(w, F.lit("^[0-9]+")))))
    alike = ["words", "first", "last"]
    e = graph.cut(events.select("id", words.alias("words"), "first", "last").filter(F.size("words") > 0).distinct())
    parts = e.groupBy(*alike).agg(F.ceil(F.count(F.lit(1)) / UNIT).alias("parts"))
    u = e.join(parts, alike).groupBy(*alike, F.pmod(F.xxhash64("id"), F.col("parts")).alias("part")).agg(F.collect_list("id").alias("ids"))
    # written, so that both sides of a pair have one number for a unit
    u = graph.cut(u.select(F.monotonically_increasing_id().alias("u"), *alike, F.filter("words", lambda w: F.length(w) >= shared).alias("long"), "ids"))
    # a word of one unit's words that the fewest units have: all its words are in the other only if this one is
    seen = u.select("u", F.explode("words").alias("word"))
    rare = seen.join(seen.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word").groupBy("u").agg(F.min(F.struct("n", "word"))["word"].alias("rare"))
    stretch = F.explode(F.sequence(F.floor(F.unix_date("first") / BUCKET), F.floor(F.unix_date("last") / BUCKET)))

    def meet(x: DataFrame, y: DataFrame, x_word: str, rest: Column) -> DataFrame:
        at = (F.col("x.bucket") == F.col("y.bucket")) & (F.col(f"x.{x_word}") == F.col("y.word"))
        overlap = (F.col("x.first") <= F.col("y.last")) & (F.col("y.first") <= F.col("x.last"))
        once = F.col("x.bucket") == F.floor(F.unix_date(F.greatest("x.first", "y.first")) / BUCKET)
        d = x.alias("x").join(y.alias("y"), at).filter(overlap & once).filter(rest)
        d = d.select((F.col("x.u") == F.col("y.u")).alias("own"), F.col("y.ids").alias("other"), F.explode("x.ids").alias("p")).select("own", "p", F.explode("other").alias("q"))
        return d.filter((F.col("p") < F.col("q")) | (~F.col("own") & (F.col("p") > F.col("q")))).select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))

    far = u.withColumn("bucket", stretch)
    long = far.select("u", "first", "last", "long", "ids", "bucket", F.explode("long").alias("word"))
    by_long = meet(long, long, "word", (F.col("x.u") <= F.col("y.u")) & (F.array_min(F.array_intersect("x.long", "y.long")) == F.col("x.word")))
    equal = F.size("x.words") == F.size("y.words")
    held = meet(far.join(rare, "u"), far.withColumn("word", F.explode("words")), "rare", (~equal | (F.col("x.u") <= F.col("y.u"))) & ~F.arrays_overlap("x.long", "y.long") & (F.size(F.array_except("x.words", "y.words")) == 0))
    d = by_long.unionByName(held)
    # an id on rows with other words or dates may meet another one more than once
    return d.distinct() if not e.groupBy("id").count().filter("count > 1").isEmpty() else d


def festival_overlay(rows: DataFrame, own: DataFrame, last: DataFrame, fresh: DataFrame, prelim: DataFrame, sticky: DataFrame, kept_venues: list, festival_venues: list, cover: list[tuple[str, str]], floor: str, end: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(slots, preliminary cells, log: festival, slot, kind) after the festivals' own programmes.

    rows, own: slots (venue, item, date, time).  last, fresh: festival and slots, of festivals read
    this run.  prelim: venue, prelim_from.  sticky: cells marked preliminary last run.  A kept venue keeps its
    last rows, unless the festival files the screening elsewhere now.
    """
    slot, cell = ["venue", "item", "date", "time"], ["venue", "item", "date"]
    lo, hi = F.lit(floor).cast("date"), F.lit(end).cast("date")
    now = fresh.select("festival", *slot).distinct()
    elsewhere = last.alias("l").join(now.alias("n"), (F.col("l.festival") == F.col("n.festival")) & (F.col("l.item") == F.col("n.item")) & (F.col("l.date") == F.col("n.date")) & (F.col("l.time") == F.col("n.time")) & (F.col("l.venue") != F.col("n.venue")), "left_semi").select("festival", *slot)
    gone = last.filter(~F.col("venue").isin(*kept_venues)).select("festival", *slot).unionByName(elsewhere).select(*slot).join(own.select(*slot), slot, "left_anti")
    on_cover = F.lit(False)
    for a, b in cover:
        on_cover = on_cover | F.col("date").between(F.lit(a).cast("date"), F.lit(b).cast("date"))
    theirs = F.col("venue").isin(*festival_venues)
    kept = rows.select(*slot).distinct().join(gone.distinct(), slot, "left_anti").filter(~(theirs & on_cover))
    new = now.filter(F.col("date").between(lo, hi))
    new = new.join(own.select(*slot, F.lit(1).alias("same")).distinct(), slot, "left").join(own.select(*cell, F.lit(1).alias("day")).distinct(), cell, "left").join(prelim, "venue", "left")
    at = own.select("venue", "date", "time", F.col("item").alias("other")).distinct()
    kind = F.when(theirs, "confirmed").when(F.col("same") == 1, "listed").when(F.col("day") == 1, "contradicted").when(F.col("date") < F.coalesce("prelim_from", lo), "prelim_row").otherwise("prelim_date")
    new = new.withColumn("kind", kind)
    clash = new.filter(F.col("kind").isin("prelim_row", "prelim_date")).join(at, ["venue", "date", "time"]).filter("other <> item").select("festival", *slot, F.lit("clash").alias("kind")).distinct()
    added = new.filter(~F.col("kind").isin("listed", "contradicted")).select(*slot).distinct()
    out = kept.unionByName(added).distinct()
    marked = new.filter("kind = 'prelim_row'").select(*cell)
    still = sticky.select(*cell).join(out.select(*cell).distinct(), cell, "left_semi").join(own.select(*cell), cell, "left_anti").join(prelim, "venue").filter(~theirs & (F.col("date") < F.col("prelim_from")) & F.col("date").between(lo, hi))
    return out, marked.unionByName(still.select(*cell)).distinct(), new.select("festival", *slot, "kind").unionByName(clash)


def festival_rows(log: DataFrame, shown: DataFrame, screens: DataFrame, venues: list) -> DataFrame:
    """Slots of festival screenings at venues, with festival and url: those that stand as they are, and contradicted ones where the venue shows the item exactly once that day.

    screens: slots with url.
    """
    slot, cell = ["venue", "item", "date", "time"], ["venue", "item", "date"]
    own = log.filter(F.col("venue").isin(*venues))
    url = screens.groupBy(*slot).agg(F.max("url").alias("url"))
    stand = own.filter(F.col("kind").isin("confirmed", "prelim_row", "prelim_date", "listed")).join(shown.select(*slot).distinct(), slot).groupBy(*slot).agg(F.min("festival").alias("festival")).join(url, slot, "left")
    once = shown.select(*slot).distinct().groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("there")).filter("n = 1")
    other = own.filter("kind = 'contradicted'").join(url, slot, "left").join(once, cell).select(*cell, F.col("there").alias("time"), "festival", "url").join(stand.select(*slot), slot, "left_anti")
    other = other.groupBy(*slot).agg(F.min(F.struct("festival", "url")).alias("x")).select(*slot, "x.festival", "x.url")
    return stand.select(*slot, "festival", "url").unionByName(other)


def festival_marks(log: DataFrame, shown: DataFrame) -> DataFrame:
    """festival, items: the items of its own programme among the rows shown."""
    slot = ["venue", "item", "date", "time"]
    d = log.filter(F.col("kind").isin("confirmed", "prelim_row", "prelim_date", "listed")).join(shown.select(*slot).distinct(), slot, "left_semi")
    return d.groupBy("festival").agg(F.array_join(F.array_sort(F.collect_set("item")), ",").alias("items"))


def seller_times(rows: DataFrame, shown: DataFrame, most: int = 90) -> DataFrame:
    """venue, item, date, time, seller, moved: a seller's start replaces the venue's on the same day within most minutes, if no other row has it.

    rows: one a slot, with seller (may be null).  Rows of one cell are taken in order of their time: a slot that a
    row moved to is taken for the next ones, and one it left is free.  Cells are small, and each is folded on its own.
    """
    minute = lambda c: F.substring(c, 1, 2).cast("int") * 60 + F.substring(c, 4, 2).cast("int")
    cell = ["venue", "item", "date"]
    d = rows.select(*cell, "time", "seller").withColumn("gap", F.abs(minute(F.col("seller")) - minute(F.col("time"))))
    g = d.groupBy(*cell).agg(F.array_sort(F.collect_list(F.struct("time", "seller", "gap"))).alias("r"))
    start = F.struct(F.transform("r", lambda x: x["time"]).alias("taken"), F.expr("cast(array() as array<struct<time:string,seller:string,moved:boolean>>)").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        moves = F.coalesce((x["seller"] != x["time"]) & (x["gap"] <= most) & ~F.array_contains(acc["taken"], x["seller"]), F.lit(False))
        taken = F.when(moves, F.concat(F.array_remove(acc["taken"], x["time"]), F.array(x["seller"]))).otherwise(acc["taken"])
        return F.struct(taken.alias("taken"), F.concat(acc["out"], F.array(F.struct(F.when(moves, x["seller"]).otherwise(x["time"]).alias("time"), x["seller"].alias("seller"), moves.alias("moved")))).alias("out"))

    return g.select(*cell, F.explode(F.aggregate("r", start, step, lambda a: a["out"])).alias("x")).select(*cell, "x.time", "x.seller", "x.moved")


def place_moves(rows: DataFrame, venues: list, own: DataFrame) -> DataFrame:
    """Slots and outcome by the venue a seller names (place): moved, kept (the venue lists it itself) or outside."""
    slot = ["venue", "item", "date", "time"]
    d = rows.filter(F.col("place").isNotNull() & (F.col("place") != F.col("venue"))).join(own.select(*slot, F.lit(1).alias("own")).distinct(), slot, "left")
    return d.select(*slot, "place", F.when(~F.col("place").isin(*venues), "outside").when(F.col("own") == 1, "kept").otherwise("moved").alias("outcome"))


def venue_outcome(kept: DataFrame, fresh: DataFrame, policy: DataFrame) -> DataFrame:
    """Of each venue how many cells this run vouched for, how many are held, and what becomes of them: festival, kept or removed."""
    cell = ["venue", "item", "date"]
    d = kept.select(*cell).distinct().join(fresh.select(*cell).distinct().withColumn("ok", F.lit(1)), cell, "left")
    d = d.groupBy("venue").agg(F.count("ok").alias("vouched"), F.count_if(F.col("ok").isNull()).alias("held")).join(policy, "venue", "left")
    return d.select("venue", "vouched", "held", F.when(F.col("held") == 0, "festival").when(F.coalesce("expired", F.lit(False)), "removed").otherwise("kept").alias("outcome"))


def trending(results: DataFrame, order: list[str], key: str) -> DataFrame:
    """Ranks from 1 by first appearance."""
    first = results.groupBy(key).agg(F.min(F.struct(*order)).alias("at"))
    return running(first, [], [F.col("at")]).select(key, "rank")


def keep_trend(current: DataFrame, previous: DataFrame, ranks: DataFrame | None, key: str, external: str) -> DataFrame:
    """The rank of each record: this run's, or with no answer last run's if the record still means the same."""
    if ranks is not None:
        return current.join(ranks, external, "left")
    old = previous.select(key, F.col(external).alias("was"), F.col("rank").alias("r"))
    return current.join(old, key, "left").withColumn("rank", F.when(F.col("was") == F.col(external), F.col("r"))).drop("was", "r")


def first_names(rows: DataFrame, group: str, order: str, name: str, n: int) -> DataFrame:
    """The first n different names of each group, joined in order."""
    one = rows.groupBy(group, name).agg(F.min(order).alias("at"))
    best = one.withColumn("k", F.row_number().over(W.partitionBy(group).orderBy("at", name))).filter(F.col("k") <= n)
    listed = F.array_sort(F.collect_list(F.struct("k", name)))
    return best.groupBy(group).agg(F.array_join(F.transform(listed, lambda x: x[name]), ", ").alias("names"))


def summarise_runs(runs: DataFrame, key: str) -> DataFrame:
    """One line a key: running beats success, success beats the last run's conclusion; attempts in all."""
    last = F.max_by("conclusion", F.struct("started", "run"))
    said = F.when(F.bool_or(F.col("status") != "completed"), "running").when(F.bool_or(F.coalesce(F.col("conclusion") == "success", F.lit(False))), "success").otherwise(F.coalesce(last, F.lit("unknown")))
    return runs.groupBy(key).agg(said.alias("conclusion"), F.sum(F.greatest(F.lit(1), F.coalesce("attempt", F.lit(1)))).alias("attempts"), F.max_by("run", F.struct("started", "run")).alias("last_run"))


def contradiction(checks: list[tuple[str, Column]]) -> Column:
    """The name of the first fact that two records disagree on; an unknown fact abstains."""
    return F.coalesce(*[F.when(~F.coalesce(test, F.lit(True)), name) for name, test in checks])
