"""Merges and calendars over slots made of line items and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import calendar, merge
from plumbline.registry import query
from plumbline.session import table

FLOOR, END = "1998-06-01", "1998-08-06"
SLOTS_SQL = """slots AS (SELECT l_suppkey % 6 AS venue, l_partkey % 5 AS item, CAST(l_shipdate AS DATE) AS date,
  lpad(CAST(10 + l_linenumber AS VARCHAR), 2, '0') || ':00' AS time, l_orderkey % 3 AS src FROM lineitem),
w AS (SELECT * FROM slots WHERE date BETWEEN DATE '1998-06-01' AND DATE '1998-08-06')"""
VENUES = [
    (0, "official", "1998-06-01", "1998-07-05", True, None, None, False),
    (1, "official", "1998-06-10", "1998-07-01", False, "1998-06-08", None, False),
    (2, "unreachable", None, None, True, None, "1998-06-20", False),
    (3, "unreachable", None, None, True, None, "1998-06-20", True),
    (4, "none", None, None, True, None, None, False),
    (5, "none", None, None, False, None, None, False),
]


def _sql(v) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, (int, bool)) else f"'{v}'"


VENUES_SQL = (
    "venues AS (SELECT venue, status, CAST(cf AS DATE) AS cf, CAST(ct AS DATE) AS ct, fetched, CAST(prev_prelim AS DATE) AS prev_prelim, CAST(confirmed_to AS DATE) AS confirmed_to, expired FROM (VALUES "
    + ", ".join("(" + ", ".join(_sql(v) for v in row) + ")" for row in VENUES)
    + ") v(venue, status, cf, ct, fetched, prev_prelim, confirmed_to, expired))"
)


def slots(spark: SparkSession, sf: str, src: int | None = None) -> DataFrame:
    d = table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 6).alias("venue"),
        (F.col("l_partkey") % 5).alias("item"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.concat((F.col("l_linenumber") + 10).cast("string"), F.lit(":00")).alias("time"),
        (F.col("l_orderkey") % 3).alias("src"),
    )
    return d if src is None else d.filter(F.col("src") == src).drop("src")


def venues(spark: SparkSession) -> DataFrame:
    d = spark.createDataFrame(VENUES, "venue long, status string, cf string, ct string, fetched boolean, prev_prelim string, confirmed_to string, expired boolean")
    return d.withColumns({c: F.col(c).cast("date") for c in ("cf", "ct", "prev_prelim", "confirmed_to")})


def _dated(d: DataFrame) -> DataFrame:
    return d.withColumns({c: F.col(c).cast("string") for c, t in d.dtypes if t == "date"})


@query("window_cells", f"WITH {SLOTS_SQL} SELECT venue, item, CAST(date AS VARCHAR) AS date, string_agg(DISTINCT time, ',' ORDER BY time) AS times FROM w GROUP BY ALL")
def window_cells(spark, sf):
    return _dated(merge.cells(merge.in_window(slots(spark, sf), FLOOR, END)))


@query("calendar_fill", """WITH days AS (SELECT CAST(d AS DATE) AS date FROM generate_series(TIMESTAMP '1998-06-01', TIMESTAMP '1998-08-06', INTERVAL 1 DAY) t(d))
SELECT CAST(date AS VARCHAR) AS date, count(o_orderkey) AS n FROM days LEFT JOIN orders o ON CAST(o_orderdate AS DATE) = date GROUP BY 1""")
def calendar_fill(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return _dated(calendar.dense_counts(rows, calendar.window_days(spark, FLOOR)))


MERGE_SQL = f"""WITH {SLOTS_SQL}, {VENUES_SQL},
o AS (SELECT w.*, v.* EXCLUDE (venue) FROM w JOIN venues v USING (venue) WHERE src = 0),
s AS (SELECT w.*, v.* EXCLUDE (venue) FROM w JOIN venues v USING (venue) WHERE src = 1),
p AS (SELECT w.*, v.* EXCLUDE (venue) FROM w JOIN venues v USING (venue) WHERE src = 2),
own AS (SELECT * FROM o WHERE status = 'official' AND date >= cf),
extra AS (SELECT DISTINCT venue, item, date FROM own WHERE date > ct),
kept AS (SELECT * FROM p WHERE status = 'unreachable' AND NOT expired),
merged AS (
  SELECT venue, item, date, time, 'official' AS source, status FROM own
  UNION SELECT venue, item, date, time, 'secondary', status FROM s WHERE status = 'official' AND fetched AND date > ct AND (venue, item, date) NOT IN (SELECT (venue, item, date) FROM extra)
  UNION SELECT venue, item, date, time, 'previous', status FROM p WHERE status = 'official' AND NOT fetched AND date > ct AND (venue, item, date) NOT IN (SELECT (venue, item, date) FROM extra)
  UNION SELECT venue, item, date, time, 'previous', status FROM p WHERE status = 'official' AND cf > DATE '{FLOOR}' AND date < cf AND date < prev_prelim
  UNION SELECT venue, item, date, time, 'previous', status FROM kept
  UNION SELECT venue, item, date, time, 'secondary', status FROM s WHERE status = 'unreachable' AND (expired OR (date > confirmed_to AND (venue, date) NOT IN (SELECT (venue, date) FROM kept)))
  UNION SELECT venue, item, date, time, 'secondary', status FROM s WHERE status = 'none' AND fetched
  UNION SELECT venue, item, date, time, 'previous', status FROM p WHERE status = 'none' AND NOT fetched AND NOT expired)
"""


def _merged(spark, sf):
    return merge.authoritative_merge(slots(spark, sf, 0), slots(spark, sf, 1), slots(spark, sf, 2), venues(spark), FLOOR, END)


def _status(status: str):
    sql = MERGE_SQL + f"SELECT venue, item, CAST(date AS VARCHAR) AS date, source, string_agg(DISTINCT time, ',' ORDER BY time) AS times FROM merged WHERE status = '{status}' GROUP BY ALL"

    @query(f"merge_{status}", sql)
    def run(spark, sf):
        rows, _ = _merged(spark, sf)
        return _dated(merge.cells(rows.filter(F.col("status") == status), [*merge.CELL, "source"]))


for _s in ("official", "unreachable", "none"):
    _status(_s)


@query("merge_conflicts", MERGE_SQL + """, log AS (
SELECT venue, item, date, time, 'discarded' AS reason FROM s WHERE status = 'official' AND date BETWEEN cf AND ct AND (venue, item, date, time) NOT IN (SELECT (venue, item, date, time) FROM own)
UNION SELECT venue, item, date, time, 'kept row wins' FROM s WHERE status = 'unreachable' AND (venue, item, date) IN (SELECT (venue, item, date) FROM kept) AND (venue, item, date, time) NOT IN (SELECT (venue, item, date, time) FROM kept))
SELECT venue, item, CAST(date AS VARCHAR) AS date, time, reason FROM log""")
def merge_conflicts(spark, sf):
    return _dated(_merged(spark, sf)[1])


@query("merge_prelim_from", f"WITH {VENUES_SQL} SELECT venue, CAST(CASE WHEN status = 'official' THEN ct + 1 ELSE DATE '{FLOOR}' END AS VARCHAR) AS prelim_from FROM venues")
def merge_prelim_from(spark, sf):
    return _dated(merge.prelim_from(venues(spark), FLOOR))


@query("merge_excluded", f"""WITH {SLOTS_SQL}, x AS (SELECT DISTINCT venue, item, date, time FROM w WHERE item = 0 AND src = 2),
u AS (SELECT venue, item, date, time, 0 AS rank FROM w WHERE src = 0 UNION ALL SELECT venue, item, date, time, 1 FROM w WHERE src = 1 AND (venue, item, date, time) NOT IN (SELECT (venue, item, date, time) FROM x)
UNION ALL SELECT venue, item, date, time, 2 FROM w WHERE src = 2 AND (venue, item, date, time) NOT IN (SELECT (venue, item, date, time) FROM x))
SELECT venue, item, CAST(date AS VARCHAR) AS date, time, min(rank) AS rank FROM u GROUP BY ALL""")
def merge_excluded(spark, sf):
    src = [merge.in_window(slots(spark, sf, i), FLOOR, END) for i in range(3)]
    return _dated(merge.first_writer_merge(src, src[2].filter("item = 0"), [*merge.CELL, "time"]))


OVERLAY_SQL = f"""WITH {SLOTS_SQL}, {VENUES_SQL}, b AS (SELECT DISTINCT venue, item, date, time FROM w WHERE src = 0), f AS (SELECT DISTINCT venue, item, date, time FROM w WHERE src = 1),
pf AS (SELECT venue, CASE WHEN status = 'official' THEN ct + 1 ELSE DATE '{FLOOR}' END AS prelim_from FROM venues),
r AS (SELECT f.*, CASE WHEN (venue, item, date, time) IN (SELECT (venue, item, date, time) FROM b) THEN 'listed' WHEN (venue, item, date) IN (SELECT (venue, item, date) FROM b) THEN 'contradicted' ELSE 'added' END AS outcome, date < prelim_from AS before FROM f LEFT JOIN pf USING (venue))
"""


@query("overlay_listed_contradicted", OVERLAY_SQL + "SELECT venue, outcome, count(*) AS n FROM r GROUP BY ALL")
def overlay_listed_contradicted(spark, sf):
    return _overlaid(spark, sf).groupBy("venue", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query("overlay_prelim_rows", OVERLAY_SQL + "SELECT venue, item, CAST(date AS VARCHAR) AS date, time, outcome, CASE WHEN outcome = 'added' THEN coalesce(before, false) END AS row_prelim FROM r")
def overlay_prelim_rows(spark, sf):
    return _dated(_overlaid(spark, sf))


def _overlaid(spark, sf):
    a, b = (merge.in_window(slots(spark, sf, i), FLOOR, END) for i in (1, 0))
    return merge.overlay(a, b, merge.prelim_from(venues(spark), FLOOR))


_PAIR = "SELECT o_orderkey AS {0}_id, o_custkey % 40 AS who, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS what FROM orders WHERE o_orderkey % 2 = {1}"


@query("reconcile_passes", f"""WITH l AS ({_PAIR.format('left', 0)}), r AS ({_PAIR.format('right', 1)}),
p1 AS (SELECT left_id, right_id FROM (SELECT *, row_number() OVER (PARTITION BY who, date, what ORDER BY left_id) AS n FROM l) a JOIN (SELECT *, row_number() OVER (PARTITION BY who, date, what ORDER BY right_id) AS n FROM r) b USING (who, date, what, n)),
l2 AS (SELECT * FROM l WHERE left_id NOT IN (SELECT left_id FROM p1)), r2 AS (SELECT * FROM r WHERE right_id NOT IN (SELECT right_id FROM p1)),
p2 AS (SELECT left_id, right_id FROM (SELECT *, row_number() OVER (PARTITION BY who, date ORDER BY left_id) AS n FROM l2) a JOIN (SELECT *, row_number() OVER (PARTITION BY who, date ORDER BY right_id) AS n FROM r2) b USING (who, date, n)),
l3 AS (SELECT * FROM l2 WHERE left_id NOT IN (SELECT left_id FROM p2)), r3 AS (SELECT * FROM r2 WHERE right_id NOT IN (SELECT right_id FROM p2)),
p3 AS (SELECT left_id, right_id FROM (SELECT *, row_number() OVER (PARTITION BY date, what ORDER BY left_id) AS n FROM l3) a JOIN (SELECT *, row_number() OVER (PARTITION BY date, what ORDER BY right_id) AS n FROM r3) b USING (date, what, n))
SELECT *, 1 AS pass FROM p1 UNION ALL SELECT *, 2 FROM p2 UNION ALL SELECT *, 3 FROM p3""")
def reconcile_passes(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 40).alias("who"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderpriority").alias("what"))
    left = o.filter("o_orderkey % 2 = 0").withColumnRenamed("o_orderkey", "left_id")
    right = o.filter("o_orderkey % 2 = 1").withColumnRenamed("o_orderkey", "right_id")
    return merge.reconcile_passes(left, right, [["who", "date", "what"], ["who", "date"], ["date", "what"]], "left_id", "right_id")


@query("rehome_rows", f"""WITH {SLOTS_SQL}, m AS (SELECT * FROM (VALUES (0, 3), (1, 4)) m(venue, host))
SELECT DISTINCT w.venue AS from_venue, m.host AS venue, item, CAST(date AS VARCHAR) AS date, time FROM w JOIN m USING (venue) WHERE src = 1 AND (m.host, item, date, time) NOT IN (SELECT (venue, item, date, time) FROM w WHERE src = 0)""")
def rehome_rows(spark, sf):
    a, b = (merge.in_window(slots(spark, sf, i), FLOOR, END) for i in (1, 0))
    return _dated(merge.rehome(a.distinct(), b, spark.createDataFrame([(0, 3), (1, 4)], "venue long, host long")))


@query("relocate_rows", f"""WITH {SLOTS_SQL}, m AS (SELECT * FROM (VALUES (0, 1, 5), (2, 3, 4)) m(venue, item, dst))
SELECT coalesce(dst, w.venue) AS venue, w.item, CAST(date AS VARCHAR) AS date, string_agg(DISTINCT time, ',' ORDER BY time) AS times FROM w LEFT JOIN m ON w.venue = m.venue AND w.item = m.item GROUP BY ALL""")
def relocate_rows(spark, sf):
    return _dated(merge.relocate(merge.in_window(slots(spark, sf), FLOOR, END), spark.createDataFrame([(0, 1, 5), (2, 3, 4)], "venue long, item long, dst long")))


@query("confirm_cut_days", f"""WITH {SLOTS_SQL} SELECT DISTINCT venue, CAST(date AS VARCHAR) AS date FROM w o WHERE src = 0 AND NOT EXISTS (SELECT 1 FROM w s WHERE s.src = 1 AND s.venue = o.venue AND s.date = o.date AND (s.venue, s.item, s.date, s.time) NOT IN (SELECT (venue, item, date, time) FROM w WHERE src = 0))""")
def confirm_cut_days(spark, sf):
    a, b = (merge.in_window(slots(spark, sf, i), FLOOR, END) for i in (0, 1))
    return _dated(merge.confirmed_days(a, b))


@query("semi_corroborate", f"WITH {SLOTS_SQL} SELECT DISTINCT venue, item, CAST(date AS VARCHAR) AS date, time FROM w WHERE src = 0 AND (venue, item, date, time) IN (SELECT (venue, item, date, time) FROM w WHERE src = 1)")
def semi_corroborate(spark, sf):
    a, b = (merge.in_window(slots(spark, sf, i), FLOOR, END) for i in (0, 1))
    return _dated(a.join(b, [*merge.CELL, "time"], "left_semi").distinct())


@query("anti_superseded", "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-08-06')")
def anti_superseded(spark, sf):
    shown = table(spark, sf, "lineitem").filter(F.col("l_shipdate").cast("date").between(FLOOR, END)).select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf, "part").select("p_partkey", "p_name").join(shown, "p_partkey", "left_anti")


_EV = "SELECT event_id, user_id, CAST(ts AS DATE) AS day, CAST(floor(epoch(ts) / 60) AS BIGINT) AS minute FROM events WHERE event_type = '{}'"


@query("nearest_slot_90", f"""WITH a AS ({_EV.format('click')}), b AS ({_EV.format('purchase')}),
j AS (SELECT a.event_id AS left_id, b.event_id AS right_id, abs(a.minute - b.minute) AS gap, b.minute AS there FROM a JOIN b USING (user_id) WHERE abs(a.minute - b.minute) <= 90)
SELECT left_id, right_id, gap FROM (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY gap, there, right_id) AS n FROM j) WHERE n = 1""")
def nearest_slot_90(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 60).alias("minute"))
    a, b = (e.filter(F.col("event_type") == t) for t in ("click", "purchase"))
    return merge.nearest_within(a.withColumnRenamed("event_id", "left_id"), b.withColumnRenamed("event_id", "right_id"), ["user_id"], "minute", 90, "left_id", "right_id")


@query("unique_link_assignment", """WITH d AS (SELECT DISTINCT event_id // 3 AS key, (event_id // 2)::VARCHAR || '-' || event_type AS url FROM events)
SELECT key, url FROM (SELECT *, count(*) OVER (PARTITION BY key) AS a, count(*) OVER (PARTITION BY url) AS b FROM d) WHERE a = 1 AND b = 1""")
def unique_link_assignment(spark, sf):
    d = table(spark, sf, "events").select(F.expr("event_id div 3").alias("key"), F.concat_ws("-", F.expr("cast(event_id div 2 as string)"), "event_type").alias("url"))
    return merge.unique_links(d, "key", "url")


@query("misplaced_links", """WITH l AS (SELECT DISTINCT user_id % 10 AS venue, json_extract_string(props, '$.k') || event_type || (event_id // 200) AS url FROM events)
SELECT venue, l.url, venues FROM l JOIN (SELECT url, count(DISTINCT venue) AS venues FROM l GROUP BY 1 HAVING count(DISTINCT venue) > 1) m ON l.url = m.url""")
def misplaced_links(spark, sf):
    d = table(spark, sf, "events").select((F.col("user_id") % 10).alias("venue"), F.concat(F.get_json_object("props", "$.k"), "event_type", F.expr("cast(event_id div 200 as string)")).alias("url"))
    return merge.misplaced_links(d.distinct())


@query("keep_previous_misses", """WITH p AS (SELECT user_id AS key, max(event_type) AS value, CAST(user_id % 4 AS BIGINT) AS misses FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1),
f AS (SELECT user_id AS key, min(event_type) AS value FROM events WHERE ts >= TIMESTAMP '2024-01-29' GROUP BY 1)
SELECT * FROM (SELECT coalesce(f.key, p.key) AS key, coalesce(f.value, p.value) AS value, CASE WHEN f.key IS NOT NULL THEN 0 ELSE misses + 1 END AS misses FROM p FULL JOIN f ON p.key = f.key) WHERE misses < 3""")
def keep_previous_misses(spark, sf):
    e = table(spark, sf, "events").withColumnRenamed("user_id", "key")
    p = e.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")).groupBy("key").agg(F.max("event_type").alias("value")).withColumn("misses", F.col("key") % 4)
    f = e.filter(F.col("ts") >= F.lit("2024-01-29").cast("timestamp_ntz")).groupBy("key").agg(F.min("event_type").alias("value"))
    return merge.keep_previous(p, f, "key", "value", "misses", 3)


@query("fill_empty_merge", """WITH a AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name FROM customer WHERE c_custkey % 4 < 3),
b AS (SELECT o_custkey AS key, max(o_orderstatus) AS segment, min(o_orderpriority) AS name FROM orders GROUP BY 1)
SELECT coalesce(a.key, b.key) AS key, coalesce(nullif(a.segment, ''), b.segment) AS segment, coalesce(nullif(a.name, ''), b.name) AS name FROM a FULL JOIN b ON a.key = b.key""")
def fill_empty_merge(spark, sf):
    key = F.col("c_custkey")
    a = table(spark, sf, "customer").filter("c_custkey % 4 < 3").select(key.alias("key"), F.when(key % 3 == 0, "").when(key % 5 == 0, None).otherwise(F.col("c_mktsegment")).alias("segment"), F.when(key % 2 == 0, F.col("c_name")).alias("name"))
    b = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.max("o_orderstatus").alias("segment"), F.min("o_orderpriority").alias("name"))
    return merge.fill_empty(a, b, "key", ["segment", "name"])


@query("event_membership", f"""WITH {SLOTS_SQL}, items AS (SELECT p_partkey AS item, p_name || ' ' || p_brand AS title FROM part),
one AS (SELECT title, min(item) AS item FROM items GROUP BY 1 HAVING count(*) = 1), e AS (SELECT s_suppkey AS event, s_suppkey % 100 AS venue, DATE '1997-01-01' + CAST(s_suppkey AS INTEGER) AS f, DATE '1999-01-01' + CAST(s_suppkey AS INTEGER) AS t FROM supplier),
x AS (SELECT event, venue, f, t, title FROM e JOIN items ON items.item % 100 = e.event % 100)
SELECT DISTINCT event, one.item FROM x JOIN one USING (title) JOIN lineitem l ON l.l_suppkey = x.venue AND l.l_partkey = one.item WHERE CAST(l_shipdate AS DATE) BETWEEN f AND t""")
def event_membership(spark, sf):
    items = table(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.concat_ws(" ", "p_name", "p_brand").alias("title"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("event"), (F.col("s_suppkey") % 100).alias("venue"), F.col("s_suppkey").cast("int").alias("k"))
    titles = items.groupBy((F.col("item") % 100).alias("k100")).agg(F.collect_set("title").alias("titles"))
    e = s.join(titles, F.col("event") % 100 == F.col("k100")).select("event", "venue", F.expr("date_add(date'1997-01-01', k)").alias("from_date"), F.expr("date_add(date'1999-01-01', k)").alias("to_date"), "titles")
    d = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("venue"), F.col("l_partkey").alias("item"), F.col("l_shipdate").cast("date").alias("date"))
    return merge.membership(e, items, d)


_DAYS = "SELECT o_custkey % 30 AS k, CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY ALL"


def _days(spark, sf):
    return table(spark, sf, "orders").groupBy((F.col("o_custkey") % 30).alias("k"), F.col("o_orderdate").cast("date").alias("date")).agg(F.count(F.lit(1)).alias("n"))


_ISLANDS = f"WITH d AS ({_DAYS}), i AS (SELECT k, date, date - CAST(row_number() OVER (PARTITION BY k ORDER BY date) AS INTEGER) AS g FROM d), r AS (SELECT k, min(date) AS first, max(date) AS last, count(*) AS days FROM i GROUP BY k, g) "


@query("islands_encode", _ISLANDS + "SELECT k, CAST(first AS VARCHAR) AS first, CAST(last AS VARCHAR) AS last, days FROM r")
def islands_encode(spark, sf):
    return _dated(calendar.islands(_days(spark, sf), ["k"]))


@query("islands_decode", _ISLANDS + "SELECT k, CAST(CAST(unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS date FROM r WHERE days >= 2")
def islands_decode(spark, sf):
    return _dated(calendar.days_of(calendar.islands(_days(spark, sf), ["k"]).filter("days >= 2"), ["k"]))


@query("published_through", f"""WITH days AS (SELECT CAST(d AS DATE) AS date FROM generate_series(TIMESTAMP '1998-06-01', TIMESTAMP '1998-08-06', INTERVAL 1 DAY) t(d)), ks AS (SELECT DISTINCT o_custkey % 30 AS k FROM orders),
c AS (SELECT o_custkey % 30 AS k, CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY ALL), d AS (SELECT ks.k, days.date, CASE WHEN (ks.k = 4 AND days.date = DATE '1998-06-01') OR (ks.k % 5 = 2 AND days.date = DATE '1998-06-20') THEN NULL ELSE 8 + coalesce(n, 0) - CASE WHEN ks.k % 3 = 1 AND days.date IN (DATE '1998-06-01', DATE '1998-07-04') THEN 8 ELSE 0 END END AS n, row_number() OVER (PARTITION BY ks.k ORDER BY days.date) AS i FROM ks CROSS JOIN days LEFT JOIN c ON c.k = ks.k AND c.date = days.date),
m AS (SELECT k, median(n) AS med FROM d WHERE i <= 7 AND n > 0 GROUP BY k), o AS (SELECT d.*, coalesce(n >= greatest(1.0, med * 0.2), false) AS ok FROM d LEFT JOIN m USING (k)),
o2 AS (SELECT *, ok OR (i = 1 AND n IS NOT NULL AND coalesce(lead(ok) OVER (PARTITION BY k ORDER BY date), false)) AS ok2 FROM o), b AS (SELECT k, min(CASE WHEN NOT ok2 THEN date END) AS bad, max(date) AS last, min(date) AS first FROM o2 GROUP BY k)
SELECT k, CAST(CASE WHEN bad IS NULL THEN last WHEN bad > first THEN bad - 1 END AS VARCHAR) AS through FROM b""")
def published_through(spark, sf):
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 30).alias("k"), F.col("o_orderdate").cast("date").alias("date"))
    days = F.explode(F.sequence(F.lit(FLOOR).cast("date"), F.lit(END).cast("date")))
    daily = o.select("k").distinct().select("k", days.alias("date")).join(o.groupBy("k", "date").agg(F.count(F.lit(1)).alias("n")), ["k", "date"], "left").fillna(0, ["n"])
    k, d = F.col("k"), F.col("date").cast("string")
    # failed reads, on the first day too, and thin days
    failed = ((k == 4) & (d == "1998-06-01")) | ((k % 5 == 2) & (d == "1998-06-20"))
    thin = F.when((k % 3 == 1) & d.isin("1998-06-01", "1998-07-04"), 8).otherwise(0)
    return _dated(calendar.published_through(daily.withColumn("n", F.when(~failed, F.col("n") + 8 - thin)), ["k"]))


@query("month_complete", f"""WITH d AS ({_DAYS}), own AS (SELECT k, date_trunc('month', date)::DATE AS month, sum(n) / day(last_day(min(date))) AS rate, count(DISTINCT CASE WHEN day(date) <= 28 THEN (day(date) - 1) // 7 END) = 4 AS weeks, max(date) > last_day(min(date)) - 7 AS fin FROM d GROUP BY 1, 2),
r AS (SELECT k, (date_trunc('month', date) + INTERVAL 1 MONTH)::DATE AS month, date, n FROM d), ref AS (SELECT k, month, sum(n) / 28 AS ref_rate, count(*) AS ref_days FROM r WHERE date >= month - 28 GROUP BY 1, 2)
SELECT own.k, CAST(own.month AS VARCHAR) AS month, weeks AND fin AS spread, coalesce(ref_days >= 14 AND (rate >= 0.6 * ref_rate OR (weeks AND fin AND rate >= 0.4 * ref_rate)), false) AS complete FROM own LEFT JOIN ref ON own.k = ref.k AND own.month = ref.month""")
def month_complete(spark, sf):
    return _dated(calendar.month_complete(_days(spark, sf), ["k"]))


@query("regular_stages", f"""WITH d AS ({_DAYS}) SELECT k, count(DISTINCT (DATE '1998-06-01' - date - 1) // 7) AS weeks, count(DISTINCT date) AS n_days FROM d WHERE date < DATE '1998-06-01' AND date >= DATE '1998-06-01' - 28 GROUP BY k HAVING weeks >= 3 AND n_days >= 2""")
def regular_stages(spark, sf):
    return calendar.regular_stages(_days(spark, sf), FLOOR, ["k"])


@query("keep_policy", """WITH s AS (SELECT user_id, max(CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END) FILTER (user_id % 3 > 0) AS last_ok, min(CASE WHEN event_type = 'error' THEN CAST(ts AS DATE) END) AS failing_since FROM events GROUP BY 1)
SELECT user_id, DATE '2024-02-01' - coalesce(last_ok, failing_since, DATE '2024-02-01') AS age, (DATE '2024-02-01' - coalesce(last_ok, failing_since, DATE '2024-02-01')) > 14 AS expired FROM s""")
def keep_policy(spark, sf):
    e = table(spark, sf, "events").withColumn("d", F.col("ts").cast("date"))
    s = e.groupBy("user_id").agg(F.max(F.when((F.col("event_type") != "error") & (F.col("user_id") % 3 > 0), F.col("d"))).alias("last_ok"), F.min(F.when(F.col("event_type") == "error", F.col("d"))).alias("failing_since"))
    return calendar.keep_policy(s, "2024-02-01").select("user_id", "age", "expired")


@query("spread_through", f"WITH d AS ({_DAYS}) SELECT k, CAST(date_trunc('month', date)::DATE AS VARCHAR) AS month, count(DISTINCT CASE WHEN day(date) <= 28 THEN (day(date) - 1) // 7 END) = 4 AND max(date) > last_day(min(date)) - 7 AS spread FROM d GROUP BY 1, 2")
def spread_through(spark, sf):
    return _dated(calendar.spread_through(_days(spark, sf), ["k"]))
