"""Theatre programmes: the merge by performance, reconciliation, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import events, memory, theatre
from plumbline.plans.listings import END, FLOOR, VENUES, VENUES_SQL, venues
from plumbline.registry import query
from plumbline.session import table

KEY = "venue, item, date, time"
_ROWS = """x AS (SELECT DISTINCT l_suppkey % 6 AS venue, l_partkey % 5 AS item, CAST(l_shipdate AS DATE) AS date, (10 + l_linenumber) || ':00' AS time, 'h' || (l_partkey % 3) AS hall, l_orderkey % 4 AS src, l_orderkey % 7 AS seven FROM lineitem WHERE l_shipdate >= '1998-05-25' AND l_shipdate < '1998-08-10')"""
assert VENUES


def rows(spark, sf):
    d = table(spark, sf, "lineitem").filter((F.col("l_shipdate") >= F.lit("1998-05-25").cast("timestamp_ntz")) & (F.col("l_shipdate") < F.lit("1998-08-10").cast("timestamp_ntz")))
    return d.select(
        (F.col("l_suppkey") % 6).alias("venue"), (F.col("l_partkey") % 5).alias("item"), F.col("l_shipdate").cast("date").alias("date"), F.concat((F.col("l_linenumber") + 10).cast("string"), F.lit(":00")).alias("time"),
        F.concat(F.lit("h"), (F.col("l_partkey") % 3).cast("string")).alias("hall"), (F.col("l_orderkey") % 4).alias("src"), (F.col("l_orderkey") % 7).alias("seven")).distinct()


_TH = f"""WITH {_ROWS}, {VENUES_SQL}, v AS (SELECT venue, status, greatest(cf, DATE '{FLOOR}') AS cf, least(ct, DATE '{END}') AS ct, prev_prelim, expired, CASE WHEN NOT expired THEN coalesce(confirmed_to, prev_prelim - 1) END AS conf FROM venues),
w AS (SELECT x.*, v.* EXCLUDE (venue), date IN (SELECT date FROM x WHERE seven < 5) AS nothing FROM x JOIN v USING (venue) WHERE date BETWEEN DATE '{FLOOR}' AND DATE '{END}'),
rd AS (SELECT DISTINCT venue, date FROM x WHERE (venue + day(date)) % 4 > 0),
o AS (SELECT * FROM w WHERE src = 0), e AS (SELECT * FROM w WHERE src = 1), s AS (SELECT * FROM w WHERE src = 2 AND (venue, date) IN (SELECT (venue, date) FROM rd)), p AS (SELECT *, (venue, date) IN (SELECT (venue, date) FROM rd) AS read FROM w WHERE src = 3),
xc AS (SELECT DISTINCT venue, item, date, time FROM x WHERE seven = 0), th AS (SELECT DISTINCT venue, item, date FROM e WHERE status = 'official' AND date > ct), kept AS (SELECT * FROM p WHERE status = 'unreachable' AND NOT expired),
u AS (SELECT {KEY}, hall, 'official' AS source, 0 AS rank FROM o WHERE status = 'official' AND date BETWEEN cf AND ct
 UNION ALL SELECT {KEY}, hall, 'extra', 1 FROM e WHERE status = 'official' AND (date > ct OR date < cf)
 UNION ALL SELECT {KEY}, hall, source, rank FROM (
  SELECT {KEY}, hall, 'secondary' AS source, 2 AS rank FROM s WHERE status = 'official' AND date > ct AND (venue, item, date) NOT IN (SELECT (venue, item, date) FROM th)
  UNION ALL SELECT {KEY}, hall, 'previous', 3 FROM p WHERE status = 'official' AND date > ct AND NOT read AND (venue, item, date) NOT IN (SELECT (venue, item, date) FROM th)
  UNION ALL SELECT {KEY}, hall, 'previous', 4 FROM p WHERE status = 'official' AND cf > DATE '{FLOOR}' AND date < cf AND date < prev_prelim
  UNION ALL SELECT {KEY}, hall, 'previous', 5 FROM kept
  UNION ALL SELECT {KEY}, hall, 'secondary', 6 FROM s WHERE status = 'unreachable' AND (expired OR conf IS NULL OR date > conf) AND (venue, date) NOT IN (SELECT (venue, date) FROM kept)
  UNION ALL SELECT {KEY}, hall, 'secondary', 7 FROM s WHERE status = 'none'
  UNION ALL SELECT {KEY}, hall, 'previous', 8 FROM p WHERE status = 'none' AND NOT expired AND NOT read) WHERE (venue, item, date, time) NOT IN (SELECT (venue, item, date, time) FROM xc)) """


def _merged(spark, sf):
    x = rows(spark, sf)
    part = [x.filter(F.col("src") == i) for i in range(4)]
    read = x.filter((F.col("venue") + F.dayofmonth("date")) % 4 > 0).select("venue", "date").distinct()
    return theatre.theatre_merge(*part, x.filter("seven = 0"), read, venues(spark), FLOOR, END)


def _text(d):
    return d.withColumns({c: F.col(c).cast("string") for c, t in d.dtypes if t == "date"})


@query("theatre_merge", _TH + f"SELECT venue, item, date::VARCHAR AS date, time, hall, source FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY rank, hall, source) AS i FROM u) WHERE i = 1")
def theatre_merge(spark, sf):
    return _text(_merged(spark, sf)[0])


@query("theatre_merge_log", _TH + f", lo AS (SELECT DISTINCT {KEY}, 'discarded' AS reason FROM s WHERE status = 'official' AND date BETWEEN cf AND ct AND (venue, item, date, time) NOT IN (SELECT (venue, item, date, time) FROM o WHERE status = 'official' AND date BETWEEN cf AND ct) UNION ALL SELECT DISTINCT {KEY}, 'kept row wins' FROM s WHERE status = 'unreachable' AND (venue, item, date) IN (SELECT (venue, item, date) FROM kept) AND (venue, item, date, time) NOT IN (SELECT (venue, item, date, time) FROM kept)) SELECT venue, item, date::VARCHAR AS date, time, reason FROM lo")
def theatre_merge_log(spark, sf):
    return _text(_merged(spark, sf)[1])


@query("split_results", f"WITH {_ROWS}, c AS (SELECT * FROM (VALUES (0, DATE '1998-05-20', DATE '1998-06-30'), (1, DATE '1998-06-10', DATE '1998-07-01')) c(venue, cf, ct)) SELECT venue, item, date::VARCHAR AS date, time, hall, CASE WHEN date BETWEEN greatest(cf, DATE '{FLOOR}') AND ct THEN 'inside' ELSE 'extra' END AS part FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY seven, hall) AS i FROM x WHERE date >= DATE '{FLOOR}') JOIN c USING (venue) WHERE i = 1")
def split_results(spark, sf):
    c = spark.createDataFrame([(0, "1998-05-20", "1998-06-30"), (1, "1998-06-10", "1998-07-01")], "venue long, a string, b string").select("venue", F.col("a").cast("date").alias("cf"), F.col("b").cast("date").alias("ct"))
    d = rows(spark, sf).withColumn("at", F.struct("seven", "hall"))
    return _text(theatre.split_result(d, c, FLOOR, "at"))


@query("reconcile_lists")
def reconcile_lists(spark, sf):
    return theatre.reconcile(*_lists(spark, sf))


def _lists(spark, sf):
    """Two lists of one theatre with titles of several words; a fifth of the tickets is at another time, some titles have words more or fewer."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    title = F.concat(F.lit("grand opera number "), (F.col("o_custkey") % 5).cast("string"), F.lit(" evening"))
    p = o.select(k.alias("id"), title.alias("key"), F.col("o_orderdate").cast("date").alias("date"), F.concat((k % 5 + 15).cast("string"), F.lit(":00")).alias("time"))
    t = o.filter(k % 10 < 8).select((k + 1_000_000).alias("id"), F.when(k % 7 == 1, F.concat(title, F.lit(" by candlelight"))).when(k % 7 == 2, F.concat(F.lit("the "), title)).otherwise(title).alias("key"), F.col("o_orderdate").cast("date").alias("date"), F.concat((F.when(k % 5 == 0, k % 5 + 16).otherwise(k % 5 + 15)).cast("string"), F.lit(":00")).alias("time"))
    return p, t


@query("rehomed_excluded", """WITH e AS (SELECT l_orderkey AS n, l_suppkey % 3 AS source, l_partkey % 5 AS item, l_shipdate::DATE AS date, CASE l_orderkey % 4 WHEN 0 THEN 4 WHEN 1 THEN 5 END AS host FROM lineitem WHERE l_linenumber = 1 AND l_shipdate < '1996-01-01'),
h AS (SELECT DISTINCT l_suppkey % 6 AS venue, l_partkey % 5 AS item, l_shipdate::DATE AS date FROM lineitem WHERE l_linenumber = 2)
SELECT source, host, e.item, e.date::VARCHAR AS date, '19:00' AS time, CASE WHEN host = 5 THEN 'not read' WHEN (host, e.item, e.date) IN (SELECT (venue, item, date) FROM h) THEN 'host lists it' WHEN e.date BETWEEN DATE '1995-03-01' AND DATE '1995-09-01' THEN 'inside' ELSE 'preliminary' END AS outcome FROM e WHERE host IS NOT NULL""")
def rehomed_excluded(spark, sf):
    l, k = table(spark, sf, "lineitem"), F.col("l_orderkey") % 4
    e = l.filter((F.col("l_linenumber") == 1) & (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))).select(F.monotonically_increasing_id().alias("n"), (F.col("l_suppkey") % 3).alias("source"), (F.col("l_partkey") % 5).alias("item"), F.col("l_shipdate").cast("date").alias("date"), F.lit("19:00").alias("time"), F.when(k == 0, "играе се в театър нова сцена днес").when(k == 1, "в сити марк арт център").when(k == 2, "нова сцена или сити марк").otherwise("отменено").alias("reason"))
    hosts = spark.createDataFrame([("нова сцена", 4), ("сити марк", 5)], "name string, venue long")
    rows_ = l.filter("l_linenumber = 2").select((F.col("l_suppkey") % 6).alias("venue"), (F.col("l_partkey") % 5).alias("item"), F.col("l_shipdate").cast("date").alias("date"))
    cover = spark.createDataFrame([(4, "1995-03-01", "1995-09-01")], "venue long, a string, b string").select("venue", F.col("a").cast("date").alias("cf"), F.col("b").cast("date").alias("ct"))
    return _text(theatre.rehome(e, hosts, rows_, cover))


@query("attached_stages", f"WITH {_ROWS}, s AS (SELECT item, date, time, min(hall) AS st FROM x WHERE src = 1 GROUP BY ALL HAVING count(DISTINCT hall) = 1) SELECT x.venue, x.item, x.date::VARCHAR AS date, x.time, x.hall, coalesce(st, x.hall) AS stage FROM x LEFT JOIN s USING (item, date, time) WHERE src = 0 AND seven < 3")
def attached_stages(spark, sf):
    x = rows(spark, sf)
    return _text(theatre.attach_stage(x.filter("src = 0 and seven < 3").select("venue", "item", "date", "time", "hall"), x.filter("src = 1").select("item", "date", "time", F.col("hall").alias("stage"))))


@query("off_grid_times", "SELECT event_id, strftime(ts, '%H:%M') AS time FROM events WHERE event_type = 'click' AND minute(ts) % 5 <> 0")
def off_grid_times(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.date_format("ts", "HH:mm").alias("time"), F.when(F.col("event_type") == "click", "tickets").otherwise("programme,tickets").alias("sources"))
    return theatre.off_grid(e).drop("sources")


@query("secondary_halls", f"WITH {_ROWS} SELECT venue, count(*) FILTER (hall IN ('h0', 'h2')) AS own, count(*) FILTER (hall = 'h1') AS elsewhere FROM x GROUP BY 1")
def secondary_halls(spark, sf):
    d = theatre.own_halls(rows(spark, sf), ["h0", "h2"])
    return d.groupBy("venue").agg(F.count_if(F.col("part") == "own").alias("own"), F.count_if(F.col("part") == "elsewhere").alias("elsewhere"))


@query("complete_until")
def complete_until(spark, sf):
    o = table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit("1998-05-01").cast("timestamp_ntz")).select((F.col("o_custkey") % 12).alias("venue"), F.col("o_orderdate").cast("date").alias("date"), F.when(F.col("o_orderkey") % 3 == 0, F.substring("o_orderpriority", 1, 1)).alias("stage"))
    page = o.filter((F.col("date") >= F.lit("1998-06-12").cast("date")) | (F.col("venue") % 2 == 0))
    return _text(theatre.complete_until(page, o.select("venue", "date"), "1998-06-12"))


@query("backward_days", "WITH d AS (SELECT DISTINCT o_custkey % 40 AS venue, o_orderdate::DATE AS date FROM orders WHERE o_orderdate < '1998-06-12'), g AS (SELECT *, DATE '1998-06-12' - date - row_number() OVER (PARTITION BY venue ORDER BY date DESC) AS gap FROM d) SELECT venue, min(date)::VARCHAR AS first, count(*) AS days FROM g WHERE gap = 0 GROUP BY 1")
def backward_days(spark, sf):
    return _text(memory.backward_run(table(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("venue"), F.col("o_orderdate").cast("date").alias("date")), "1998-06-12"))


@query("seller_times")
def seller_times(spark, sf):
    x = rows(spark, sf).filter("src < 2").groupBy("venue", "item", "date", "time").agg(F.max("seven").alias("seven"))
    h = F.substring("time", 1, 2).cast("int")
    seller = F.when(F.col("seven") == 1, F.concat((h + 1).cast("string"), F.lit(":00"))).when(F.col("seven") == 2, F.concat(h.cast("string"), F.lit(":30"))).when(F.col("seven") == 3, F.concat((h + 3).cast("string"), F.lit(":00")))
    d = x.withColumn("seller", seller)
    return _text(events.seller_times(d, d))
