"""Date, event and festival queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import dates
from plumbline.operators import events, merge
from plumbline.plans.listings import END, FLOOR, SLOTS_SQL, slots
from plumbline.registry import query
from plumbline.session import table

_TODAY = "DATE '1998-11-20'"
_DM = "CAST(1 + o_orderkey % 31 AS INTEGER) AS d, CAST(1 + o_custkey % 12 AS INTEGER) AS m"
_TRY = "TRY_CAST((1998 + {k})::VARCHAR || '-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0') AS DATE)"
_OPTIONS = "[" + ", ".join(_TRY.format(k=k) for k in (-1, 0, 1)) + "]"


def _day_month(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 31 + 1).cast("int").alias("d"), (F.col("o_custkey") % 12 + 1).cast("int").alias("m"), F.lit("1998-11-20").cast("date").alias("today"))


@query("nearest_date", f"SELECT o_orderkey, list_min(list_filter({_OPTIONS}, lambda x: x >= {_TODAY} - 45))::VARCHAR AS date FROM (SELECT o_orderkey, {_DM} FROM orders)")
def nearest_date(spark, sf):
    return _day_month(spark, sf).select("o_orderkey", dates.nearest_date(F.col("d"), F.col("m"), F.col("today")).cast("string").alias("date"))


@query("nearest_year", f"SELECT o_orderkey, (list_sort(list_transform(list_filter({_OPTIONS}, lambda x: x - {_TODAY} >= -62), lambda x: {{'gap': abs(x - {_TODAY}), 'date': x}}))[1]).date::VARCHAR AS date FROM (SELECT o_orderkey, {_DM} FROM orders)")
def nearest_year(spark, sf):
    return _day_month(spark, sf).select("o_orderkey", dates.nearest_year(F.col("d"), F.col("m"), F.col("today")).cast("string").alias("date"))


_MONTH = "['" + "','".join(dates.MONTHS) + "']"


@query("find_date", f"SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN TRY_CAST('1999-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0') AS DATE) ELSE list_min(list_filter({_OPTIONS}, lambda x: x >= {_TODAY} - 45)) END::VARCHAR AS date FROM (SELECT *, {_DM} FROM orders)")
def find_date(spark, sf):
    o = table(spark, sf, "orders").withColumns({"d": (F.col("o_orderkey") % 31 + 1).cast("int"), "m": (F.col("o_custkey") % 12 + 1).cast("int")})
    word = F.element_at(F.array(*map(F.lit, dates.MONTHS)), F.col("m"))
    k, d, m = F.col("o_orderkey") % 4, F.col("d").cast("string"), F.col("m").cast("string")
    said = (
        F.when(k == 0, F.concat(F.lit("on "), F.col("o_orderdate").cast("date").cast("string"), F.lit(" at 19:00"))).when(k == 1, F.concat(d, F.lit("."), m, F.lit(".1999")))
        .when(k == 2, F.concat(d, F.lit("/"), m)).otherwise(F.concat(d, F.lit(" "), F.initcap(word)))
    )
    return o.select("o_orderkey", dates.find_date(said, F.lit("1998-11-20").cast("date")).cast("string").alias("date"))


@query("times_in_text", "SELECT l_orderkey, l_linenumber, l_partkey, list_reduce(list_sort(list_distinct([lpad((l_partkey % 24)::VARCHAR, 2, '0') || ':' || lpad((l_suppkey % 60)::VARCHAR, 2, '0'), lpad((l_suppkey % 24)::VARCHAR, 2, '0') || ':30'])), lambda x, y: x || ',' || y) AS times FROM lineitem")
def times_in_text(spark, sf):
    p, s = F.col("l_partkey") % 24, F.col("l_suppkey")
    said = F.concat(F.lit("from "), p.cast("string"), F.lit("."), F.lpad((s % 60).cast("string"), 2, "0"), F.lit(", again "), F.lpad((s % 24).cast("string"), 2, "0"), F.lit(":30 (25:00 and 1.2.2020 are none)"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(dates.times_in(said), ",").alias("times"))


@query("weekday_conflicts", "SELECT count(*) AS n, count(*) FILTER (o_custkey % 8 < 7 AND o_custkey % 8 <> isodow(o_orderdate) - 1) AS conflicts FROM orders")
def weekday_conflicts(spark, sf):
    said = F.concat(F.lit("in "), F.coalesce(F.get(F.array(*map(F.lit, dates.WEEKDAYS)), F.col("o_custkey") % 8), F.lit("any day")))
    o = table(spark, sf, "orders").select(dates.weekday_conflict(F.col("o_orderdate").cast("date"), said).alias("c"))
    return o.agg(F.count(F.lit(1)).alias("n"), F.count_if("c").alias("conflicts"))


@query("local_days", "SELECT CAST(ts + INTERVAL 2 HOUR AS DATE)::VARCHAR AS day, count(*) AS n FROM events GROUP BY 1")
def local_days(spark, sf):
    return table(spark, sf, "events").groupBy(dates.local_date(F.col("ts")).cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))


_EV = "e AS (SELECT p_partkey AS id, string_split(lower(p_name || ' ' || p_brand || ' festival ' || p_size::VARCHAR || CASE WHEN p_partkey % 9 = 0 THEN ' distinct' || (p_partkey // 40) ELSE '' END), ' ') AS ws, DATE '1998-01-01' + CAST(p_partkey % 300 AS INTEGER) AS f, DATE '1998-01-01' + CAST(p_partkey % 300 + p_size % 9 AS INTEGER) AS l FROM part)"


@query("same_events", f"""WITH {_EV}, w AS (SELECT id, f, l, list_filter(list_distinct(ws), lambda x: x <> 'festival' AND length(x) >= 2 AND NOT regexp_matches(x, '^[0-9]+')) AS k FROM e)
SELECT a.id AS a, b.id AS b FROM w a JOIN w b ON a.id < b.id AND a.f <= b.l AND b.f <= a.l WHERE list_has_all(a.k, b.k) OR list_has_all(b.k, a.k) OR len(list_filter(list_intersect(a.k, b.k), lambda x: length(x) >= 8)) > 0""")
def same_events(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    words = F.split(F.lower(F.concat(F.concat_ws(" ", "p_name", "p_brand", F.lit("festival"), F.col("p_size").cast("string")), F.when(k % 9 == 0, F.concat(F.lit(" distinct"), F.expr("cast(p_partkey div 40 as string)"))).otherwise(""))), " ")
    e = p.select(k.alias("id"), words.alias("words"), F.expr("date_add(date'1998-01-01', cast(p_partkey % 300 as int))").alias("first"), F.expr("date_add(date'1998-01-01', cast(p_partkey % 300 + p_size % 9 as int))").alias("last"))
    return events.same_event_pairs(e, ["festival"], 8)


_FEST = f"""WITH {SLOTS_SQL}, own AS (SELECT DISTINCT venue, item, date, time FROM w WHERE src = 0), las AS (SELECT DISTINCT item % 2 AS festival, venue, item, date, time FROM w WHERE src = 1 AND item < 2), fr AS (SELECT DISTINCT item % 2 AS festival, CASE WHEN venue = 3 AND item = 1 THEN 4 ELSE venue END AS venue, item, date, time FROM w WHERE src > 0 AND item < 3),
r AS (SELECT venue, item, date, time FROM w WHERE src = 0 UNION SELECT venue, item, date, time FROM las UNION SELECT venue, item, date, time FROM w WHERE src = 1),
gone AS (SELECT venue, item, date, time FROM las WHERE (venue <> 3 OR EXISTS (SELECT 1 FROM fr WHERE fr.festival = las.festival AND fr.item = las.item AND fr.date = las.date AND fr.time = las.time AND fr.venue <> las.venue)) AND (venue, item, date, time) NOT IN (SELECT (venue, item, date, time) FROM own)),
kept AS (SELECT * FROM r WHERE (venue, item, date, time) NOT IN (SELECT (venue, item, date, time) FROM gone) AND NOT (venue = 5 AND date BETWEEN DATE '1998-06-10' AND DATE '1998-06-30')),
pf AS (SELECT * FROM (VALUES (0, DATE '1998-07-01'), (1, DATE '1998-06-15'), (3, DATE '1998-07-20'), (4, DATE '1998-07-20')) p(venue, prelim_from)),
nw AS (SELECT fr.*, CASE WHEN fr.venue = 5 THEN 'confirmed' WHEN (fr.venue, item, date, time) IN (SELECT (venue, item, date, time) FROM own) THEN 'listed' WHEN (fr.venue, item, date) IN (SELECT (venue, item, date) FROM own) THEN 'contradicted' WHEN date < coalesce(prelim_from, DATE '1998-06-01') THEN 'prelim_row' ELSE 'prelim_date' END AS kind FROM fr LEFT JOIN pf USING (venue)),
cells AS (SELECT * FROM kept UNION SELECT venue, item, date, time FROM nw WHERE kind NOT IN ('listed', 'contradicted')),
clash AS (SELECT DISTINCT nw.festival, nw.venue, nw.item, nw.date, nw.time, 'clash' AS kind FROM nw JOIN own ON own.venue = nw.venue AND own.date = nw.date AND own.time = nw.time AND own.item <> nw.item WHERE kind LIKE 'prelim%'),
stick AS (SELECT DISTINCT venue, item, date FROM w WHERE src = 1 AND item > 2),
pre AS (SELECT venue, item, date FROM nw WHERE kind = 'prelim_row' UNION SELECT s.venue, s.item, s.date FROM stick s JOIN pf USING (venue) WHERE (s.venue, s.item, s.date) IN (SELECT (venue, item, date) FROM cells) AND (s.venue, s.item, s.date) NOT IN (SELECT (venue, item, date) FROM own) AND s.date < prelim_from) """


def _festival(spark, sf):
    s = [merge.in_window(slots(spark, sf, i), FLOOR, END).distinct() for i in range(3)]
    fest = (F.col("item") % 2).alias("festival")
    last = s[1].filter("item < 2").select(fest, "*")
    fresh = s[1].unionByName(s[2]).filter("item < 3").select(fest, F.when((F.col("venue") == 3) & (F.col("item") == 1), 4).otherwise(F.col("venue")).cast("long").alias("venue"), "item", "date", "time").distinct()
    prelim = spark.createDataFrame([(0, "1998-07-01"), (1, "1998-06-15"), (3, "1998-07-20"), (4, "1998-07-20")], "venue long, d string").select("venue", F.col("d").cast("date").alias("prelim_from"))
    sticky = s[1].filter("item > 2").select("venue", "item", "date").distinct()
    out = events.festival_overlay(s[0].unionByName(s[1]), s[0], last, fresh, prelim, sticky, [3], [5], [("1998-06-10", "1998-06-30")], FLOOR, END)
    return (*out, fresh)


def _text(d):
    return d.withColumn("date", F.col("date").cast("string"))


@query("festival_overlay", _FEST + "SELECT venue, item, date::VARCHAR AS date, time FROM cells")
def festival_overlay(spark, sf):
    return _text(_festival(spark, sf)[0])


@query("festival_prelim_rows", _FEST + "SELECT venue, item, date::VARCHAR AS date FROM pre")
def festival_prelim_rows(spark, sf):
    return _text(_festival(spark, sf)[1])


@query("festival_log", _FEST + "SELECT festival, venue, item, date::VARCHAR AS date, time, kind FROM nw UNION ALL SELECT festival, venue, item, date::VARCHAR, time, kind FROM clash")
def festival_log(spark, sf):
    return _text(_festival(spark, sf)[2])


@query("festival_outcome", _FEST + """, al AS (SELECT DISTINCT venue, item, date FROM cells), v AS (SELECT venue, count(*) FILTER ((venue, item, date) IN (SELECT (venue, item, date) FROM fr)) AS vouched, count(*) FILTER ((venue, item, date) NOT IN (SELECT (venue, item, date) FROM fr)) AS held FROM al GROUP BY 1)
SELECT *, CASE WHEN held = 0 THEN 'festival' WHEN venue % 2 = 1 THEN 'removed' ELSE 'kept' END AS outcome FROM v""")
def festival_outcome(spark, sf):
    rows, _, _, fresh = _festival(spark, sf)
    policy = spark.createDataFrame([(v, v % 2 == 1) for v in range(6)], "venue long, expired boolean")
    return events.venue_outcome(rows, fresh, policy)


@query("festival_sale_rows", _FEST + """, st AS (SELECT venue, item, date, time, min(festival) AS festival FROM nw WHERE kind NOT IN ('contradicted') AND venue IN (1, 5) AND (venue, item, date, time) IN (SELECT (venue, item, date, time) FROM cells) GROUP BY ALL),
once AS (SELECT venue, item, date, min(time) AS there FROM cells GROUP BY ALL HAVING count(*) = 1), ot AS (SELECT nw.venue, nw.item, nw.date, there AS time, min(festival) AS festival FROM nw JOIN once USING (venue, item, date) WHERE kind = 'contradicted' AND venue IN (1, 5) GROUP BY ALL)
SELECT venue, item, date::VARCHAR AS date, time, festival FROM st UNION ALL SELECT venue, item, date::VARCHAR, time, festival FROM ot WHERE (venue, item, date, time) NOT IN (SELECT (venue, item, date, time) FROM st)""")
def festival_sale_rows(spark, sf):
    rows, _, log, fresh = _festival(spark, sf)
    return _text(events.festival_rows(log, rows, fresh.withColumn("url", F.lit("https://x.bg/")), [1, 5]).drop("url"))


@query("festival_marks", _FEST + "SELECT festival, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM nw WHERE kind <> 'contradicted' AND (venue, item, date, time) IN (SELECT (venue, item, date, time) FROM cells) GROUP BY 1")
def festival_marks(spark, sf):
    rows, _, log, _ = _festival(spark, sf)
    return events.festival_marks(log, rows)


@query("seller_places", _FEST + "SELECT venue, item, date::VARCHAR AS date, time, place, CASE WHEN place NOT IN (0, 1, 2) THEN 'outside' WHEN (venue, item, date, time) IN (SELECT (venue, item, date, time) FROM own) THEN 'kept' ELSE 'moved' END AS outcome FROM (SELECT *, (venue + item) % 4 AS place FROM cells) WHERE place <> venue")
def seller_places(spark, sf):
    rows = _festival(spark, sf)[0]
    own = merge.in_window(slots(spark, sf, 0), FLOOR, END)
    return _text(events.place_moves(rows.withColumn("place", (F.col("venue") + F.col("item")) % 4), [0, 1, 2], own))


@query("trending_ranks", "SELECT key, row_number() OVER (ORDER BY f) AS rank FROM (SELECT user_id AS key, min(event_id) AS f FROM (SELECT event_id, (event_id * 7919) % 5003 AS user_id FROM events) GROUP BY 1)")
def trending_ranks(spark, sf):
    return events.trending(table(spark, sf, "events").withColumn("key", F.col("event_id") * 7919 % 5003), ["event_id"], "key")


@query("first_names", "SELECT p_type, string_agg(p_name, ', ' ORDER BY k) AS names FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY f, p_name) AS k FROM (SELECT p_type, p_name, min(p_partkey) AS f FROM part GROUP BY 1, 2)) WHERE k <= 5 GROUP BY 1")
def first_names(spark, sf):
    return events.first_names(table(spark, sf, "part"), "p_type", "p_partkey", "p_name", 5)


@query("run_summaries", """SELECT user_id, CASE WHEN bool_or(event_type = 'signup') THEN 'running' WHEN bool_or(event_type = 'purchase') THEN 'success' ELSE arg_max(event_type, event_id) END AS conclusion, sum(greatest(1, event_id % 3))::BIGINT AS attempts, max(event_id) AS last_run FROM (SELECT event_id, event_type, event_id // 3 AS user_id FROM events) GROUP BY 1""")
def run_summaries(spark, sf):
    status = F.when(F.col("event_type") == "signup", "running").otherwise("completed")
    said = F.when(F.col("event_type") == "purchase", "success").otherwise(F.col("event_type"))
    d = table(spark, sf, "events").select(F.expr("event_id div 3").alias("user_id"), F.col("event_id").alias("run"), F.col("event_id").alias("started"), status.alias("status"), said.alias("conclusion"), (F.col("event_id") % 3).alias("attempt"))
    return events.summarise_runs(d, "user_id")


@query("contradictions", "SELECT o_orderkey, CASE WHEN c_nationkey % 3 <> o_custkey % 3 THEN 'nation' WHEN NOT coalesce(abs(c_acctbal - o_totalprice / 100) < 2000, true) THEN 'amount' END AS fact FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 4 > 0")
def contradictions(spark, sf):
    c = table(spark, sf, "customer").filter("c_custkey % 4 > 0")
    d = table(spark, sf, "orders").join(c, F.col("c_custkey") == F.col("o_custkey"), "left")
    checks = [("nation", F.col("c_nationkey") % 3 == F.col("o_custkey") % 3), ("amount", F.abs(F.col("c_acctbal") - F.col("o_totalprice") / 100) < 2000)]
    return d.select("o_orderkey", events.contradiction(checks).alias("fact"))
