"""State between runs, and the decisions of a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import control, memory
from plumbline.registry import query
from plumbline.session import table

TODAY = "2024-02-01"
_T = f"DATE '{TODAY}'"


def _text(d):
    return d.withColumns({c: F.col(c).cast("string") for c, t in d.dtypes if t == "date"})


def _user(spark, sf):
    e = table(spark, sf, "events").withColumn("d", F.col("ts").cast("date"))
    return e.groupBy("user_id").agg(F.max("d").alias("last"), F.min("d").alias("first"), F.count(F.lit(1)).alias("n"))


_U = "u AS (SELECT user_id, max(ts)::DATE AS last, min(ts)::DATE AS first, count(*) AS n FROM events GROUP BY 1)"


@query("recorded_reads", f"""WITH {_U}, s AS (SELECT user_id AS venue, CASE WHEN user_id % 3 > 0 THEN last END AS last_ok, CASE WHEN user_id % 2 = 0 THEN last + 10 END AS old_to, CASE WHEN user_id % 5 = 0 THEN first END AS fs, CASE WHEN user_id % 5 = 0 THEN 'old' END AS le FROM u WHERE user_id % 4 < 3),
r AS (SELECT user_id AS venue, user_id % 2 = 0 AS ok, last + 20 AS new_to, CASE WHEN user_id % 7 > 0 THEN 'HTTP ' || user_id END AS error FROM u WHERE user_id % 6 > 0)
SELECT coalesce(s.venue, r.venue) AS venue, CASE WHEN ok THEN {_T} ELSE last_ok END::VARCHAR AS last_ok, CASE WHEN ok THEN new_to ELSE old_to END::VARCHAR AS covered_to, CASE WHEN ok THEN NULL WHEN NOT ok THEN coalesce(fs, {_T}) ELSE fs END::VARCHAR AS failing_since, CASE WHEN ok THEN NULL WHEN NOT ok THEN coalesce(error, 'not read') ELSE le END AS last_error FROM s FULL JOIN r ON s.venue = r.venue""")
def recorded_reads(spark, sf):
    u, k = _user(spark, sf), F.col("user_id")
    s = u.filter(k % 4 < 3).select(k.alias("venue"), F.when(k % 3 > 0, F.col("last")).alias("last_ok"), F.when(k % 2 == 0, F.date_add("last", 10)).alias("covered_to"), F.when(k % 5 == 0, F.col("first")).alias("failing_since"), F.when(k % 5 == 0, "old").alias("last_error"))
    r = u.filter(k % 6 > 0).select(k.alias("venue"), (k % 2 == 0).alias("ok"), F.date_add("last", 20).alias("covered_to"), F.when(k % 7 > 0, F.concat(F.lit("HTTP "), k.cast("string"))).alias("error"))
    return _text(memory.record_reads(s, r, TODAY))


@query("remembered_days", f"""WITH o AS (SELECT DISTINCT user_id AS venue, ts::DATE AS date, event_type AS time FROM events WHERE event_id % 2 = 0), p AS (SELECT DISTINCT user_id AS venue, ts::DATE + 10 AS date, event_type AS time FROM events WHERE event_id % 2 = 1), n AS (SELECT DISTINCT user_id AS venue, CASE WHEN user_id % 2 = 0 THEN DATE '2024-01-22' END AS until FROM events WHERE user_id % 5 > 0)
SELECT venue, date::VARCHAR AS date, time FROM o WHERE venue IN (SELECT venue FROM n) AND date < DATE '2024-01-20' AND date >= DATE '2024-01-20' - 10 UNION SELECT venue, date::VARCHAR, time FROM o WHERE venue NOT IN (SELECT venue FROM n) AND date >= DATE '2024-01-20' - 10
UNION SELECT p.venue, date::VARCHAR, time FROM p JOIN n USING (venue) WHERE date >= DATE '2024-01-20' AND date <= least(DATE '2024-01-27', coalesce(until, DATE '2024-01-27'))""")
def remembered_days(spark, sf):
    e = table(spark, sf, "events").withColumn("d", F.col("ts").cast("date"))
    cols = [F.col("user_id").alias("venue"), F.col("event_type").alias("time"), F.lit(None).cast("string").alias("stage")]
    old = e.filter("event_id % 2 = 0").select(F.col("d").alias("date"), *cols).distinct()
    page = e.filter("event_id % 2 = 1").select(F.date_add("d", 10).alias("date"), *cols).distinct()
    until = e.filter("user_id % 5 > 0").select(F.col("user_id").alias("venue"), F.when(F.col("user_id") % 2 == 0, F.lit("2024-01-22").cast("date")).alias("until")).distinct()
    return _text(memory.remember_days(old, page, until, "2024-01-20", back=10)).drop("stage")


@query("carried_halls", f"""WITH s AS (SELECT user_id AS venue, DATE '2024-01-10' + CAST(event_id % 20 AS INTEGER) AS read, ts::DATE AS date, event_type AS time, event_id % 3 AS show, 'h' || (event_id % 4) AS hall FROM events WHERE event_id % 2 = 0), r AS (SELECT DISTINCT user_id AS venue, ts::DATE AS date, event_type AS time, event_id % 3 AS show, CASE WHEN user_id % 4 = 0 THEN 'own' END AS hall FROM events),
c AS (SELECT venue, date, time, show AS sh, hall, row_number() OVER (PARTITION BY venue, date, time, show ORDER BY read DESC, hall DESC) AS i FROM (SELECT venue, read, date, time, "show" AS show, hall FROM s) WHERE DATE '2024-01-25' - read <= 14 AND date >= DATE '2024-01-25')
SELECT r.venue, r.date::VARCHAR AS date, r.time, r."show" AS item, coalesce(r.hall, c.hall) AS hall FROM r LEFT JOIN c ON c.venue = r.venue AND c.date = r.date AND c.time = r.time AND c.sh = r."show" AND i = 1""".replace("AS show,", 'AS "show",').replace("time, show AS sh", 'time, "show" AS sh').replace("time, show ORDER", 'time, "show" ORDER').replace('"show" AS show', '"show"'))
def carried_halls(spark, sf):
    e, k = table(spark, sf, "events").withColumn("date", F.col("ts").cast("date")), F.col("event_id")
    base = [F.col("user_id").alias("venue"), "date", F.col("event_type").alias("time"), (k % 3).alias("show")]
    store = e.filter(k % 2 == 0).select(*base, F.date_add(F.lit("2024-01-10").cast("date"), (k % 20).cast("int")).alias("read"), F.concat(F.lit("h"), (k % 4).cast("string")).alias("hall"))
    rows = e.select(*base, F.when(F.col("user_id") % 4 == 0, "own").alias("hall")).distinct()
    return _text(memory.carry_attributes(store, rows, "2024-01-25")).withColumnRenamed("show", "item")


@query("kept_policies", f"""WITH {_U}, s AS (SELECT user_id AS venue, CASE WHEN user_id % 3 > 0 THEN last - 12 END AS ok, last + 3 AS ct, CASE WHEN user_id % 2 = 0 THEN first END AS fs, CASE WHEN user_id % 5 > 0 THEN last + 1 END AS pp FROM u)
SELECT venue, coalesce(ok, fs, {_T})::VARCHAR AS since, {_T} - coalesce(ok, fs, {_T}) AS age, {_T} - coalesce(ok, fs, {_T}) > 14 AS expired, CASE WHEN ok IS NOT NULL THEN ct ELSE pp - 1 END::VARCHAR AS confirmed_to FROM s""")
def kept_policies(spark, sf):
    k = F.col("user_id")
    s = _user(spark, sf).select(k.alias("venue"), F.when(k % 3 > 0, F.date_sub("last", 12)).alias("last_ok"), F.date_add("last", 3).alias("covered_to"), F.when(k % 2 == 0, F.col("first")).alias("failing_since"), F.when(k % 5 > 0, F.date_add("last", 1)).alias("prev_prelim"))
    return _text(memory.kept_policy(s, TODAY))


@query("recorded_misses", f"""WITH s AS (SELECT p_partkey AS id, 'own' AS source, 'u' || p_partkey AS url, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS text FROM part WHERE p_partkey % 4 > 0), m AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN 'art' ELSE 'own' END AS ms, 'u' || p_partkey AS mu FROM part WHERE p_partkey % 2 = 0)
SELECT coalesce(s.id, m.id) AS id, CASE WHEN mu IS NOT NULL AND text IS NULL THEN ms ELSE source END AS source, text, CASE WHEN mu IS NOT NULL AND (text IS NULL OR ms = source) THEN {_T} END::VARCHAR AS tried, CASE WHEN mu IS NOT NULL AND text IS NOT NULL AND ms <> source THEN {_T} END::VARCHAR AS own_tried FROM s FULL JOIN m ON s.id = m.id""")
def recorded_misses(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    u, none = F.concat(F.lit("u"), k.cast("string")).alias("url"), F.lit(None)
    s = p.filter(k % 4 > 0).select(k.alias("id"), F.lit("own").alias("source"), u, F.when(k % 3 == 0, F.col("p_name")).alias("text"), none.cast("date").alias("tried"), none.cast("string").alias("own_url"), none.cast("date").alias("own_tried"))
    m = p.filter(k % 2 == 0).select(k.alias("id"), F.when(k % 5 == 0, "art").otherwise("own").alias("source"), u)
    return _text(memory.record_misses(s, m, TODAY)).select("id", "source", "text", "tried", "own_tried")


@query("name_lookups", f"SELECT c_name AS name FROM (SELECT c_name, CASE WHEN c_custkey % 4 > 0 THEN {_T} - CAST(c_custkey % 60 AS INTEGER) END AS asked, c_custkey % 3 = 0 AS known FROM customer) WHERE asked IS NULL OR (NOT known AND {_T} - asked >= 30) ORDER BY asked NULLS FIRST, c_name LIMIT 60")
def name_lookups(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    cache = c.filter(k % 4 > 0).select(F.col("c_name").alias("name"), F.date_sub(F.lit(TODAY).cast("date"), (k % 60).cast("int")).alias("asked"), F.when(k % 3 == 0, "yes").alias("answer"))
    return memory.name_lookups(c.select(F.col("c_name").alias("name")), cache, TODAY, 30, 60)


@query("due_again", f"""WITH s AS (SELECT event_id AS id, 'u' || user_id AS url, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'u' || user_id WHEN 2 THEN 'x' ELSE 'u' || user_id END AS ru, CASE WHEN event_id % 8 = 3 THEN 'art' ELSE 'own' END AS rs, event_id % 3 = 0 AS has, CASE WHEN event_id % 5 > 0 THEN ts::DATE END AS f, CASE WHEN event_id % 7 > 0 THEN ts::DATE + 3 END AS t, CASE WHEN event_id % 6 > 1 THEN 'u' || user_id END AS ou, ts::DATE + 20 AS ot FROM events)
SELECT id, CASE WHEN ru IS NULL THEN true WHEN NOT coalesce(ru = url AND rs = 'own', false) THEN NOT coalesce(ou = url AND {_T} - ot < 7, false) WHEN has THEN coalesce({_T} - f >= 14, true) AND (f IS NULL OR coalesce({_T} - t >= 7, true)) ELSE coalesce({_T} - t >= 7, true) END AS due FROM s""")
def due_again(spark, sf):
    e, k, d = table(spark, sf, "events"), F.col("event_id"), F.col("ts").cast("date")
    u = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    s = e.select(k.alias("id"), u.alias("url"), F.when(k % 4 == 0, None).when(k % 4 == 2, "x").otherwise(u).alias("rec_url"), F.when(k % 8 == 3, "art").otherwise("own").alias("rec_source"), F.when(k % 3 == 0, "text").alias("text"), F.when(k % 5 > 0, d).alias("fetched"), F.when(k % 7 > 0, F.date_add(d, 3)).alias("tried"), F.when(k % 6 > 1, u).alias("own_url"), F.date_add(d, 20).alias("own_tried"))
    return memory.due_again(s, TODAY, 14, 7, "own")


@query("retry_schedule", f"SELECT event_id AS id, coalesce({_T} - a, 0) <= 21 OR b IS NULL OR {_T} - b >= 7 OR l IS DISTINCT FROM t AS due FROM (SELECT event_id, CASE WHEN event_id % 9 > 0 THEN ts::DATE - 20 END AS a, CASE WHEN event_id % 5 > 0 THEN {_T} - CAST(event_id % 11 AS INTEGER) END AS b, 'l' || (event_id % 3) AS l, CASE WHEN event_id % 2 = 0 THEN 'l' || (event_id % 3) WHEN event_id % 8 = 1 THEN 'other' ELSE 'l' || (event_id % 3) END AS t FROM events)")
def retry_schedule(spark, sf):
    e, k = table(spark, sf, "events"), F.col("event_id")
    link = F.concat(F.lit("l"), (k % 3).cast("string"))
    w = e.select(k.alias("id"), F.when(k % 9 > 0, F.date_sub(F.col("ts").cast("date"), 20)).alias("first_missing"), F.when(k % 5 > 0, F.date_sub(F.lit(TODAY).cast("date"), (k % 11).cast("int"))).alias("last_try"), link.alias("link"), F.when(k % 8 == 1, "other").otherwise(link).alias("tried_link"))
    return memory.retry_schedule(w, TODAY)


@query("synopsis_choice", """WITH s AS (SELECT doc_id AS id, CASE WHEN doc_id % 4 > 0 THEN text ELSE '' END AS t, CASE WHEN doc_id % 10 = 0 THEN 'owner ' || doc_id END AS o, CASE WHEN doc_id % 3 > 0 THEN repeat('fill ' || doc_id || ' ', 1 + CAST(doc_id % 60 AS INTEGER)) END AS f, CASE WHEN doc_id % 7 = 1 THEN text END AS e FROM documents)
SELECT id, md5(CASE WHEN o IS NOT NULL THEN o WHEN fits THEN f ELSE t END) AS text, CASE WHEN o IS NOT NULL THEN 'owner' WHEN fits THEN 'page' ELSE 'seed' END AS source FROM (SELECT *, coalesce(length(trim(f)), 0) >= 120 AND (t = f OR coalesce(t = e, false) OR (length(trim(t)) < 280 AND length(trim(f)) > length(trim(t)))) AS fits FROM s)""")
def synopsis_choice(spark, sf):
    d, k = table(spark, sf, "documents"), F.col("doc_id")
    fill = F.when(k % 3 > 0, F.repeat(F.concat(F.lit("fill "), k.cast("string"), F.lit(" ")), (k % 60 + 1).cast("int")))
    s = d.select(k.alias("id"), F.when(k % 4 > 0, F.col("text")).otherwise("").alias("text"), F.when(k % 10 == 0, F.concat(F.lit("owner "), k.cast("string"))).alias("owner"), fill.alias("fill"), F.lit("page").alias("fill_source"), F.when(k % 7 == 1, F.col("text")).alias("earlier"))
    return memory.fill_choice(s).select("id", F.md5(F.col("text").cast("binary")).alias("text"), "source")


@query("pending_plan", """WITH m AS (SELECT sha1(text) AS key, min(doc_id) AS pos, max(length(text)) AS chars FROM documents WHERE sha1(text) NOT IN (SELECT sha1(text) FROM documents WHERE doc_id % 3 = 0) GROUP BY 1), s AS (SELECT m.*, CASE WHEN pos % 4 > 0 THEN DATE '2024-01-01' + CAST(pos % 9 AS INTEGER) ELSE DATE '2024-02-01' END AS since FROM m),
t AS (SELECT *, sum(chars) OVER (ORDER BY since, pos) AS total FROM s) SELECT key, since::VARCHAR AS since, chars, total <= 40000 OR total = chars AS allowed FROM t""")
def pending_plan(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.sha1(F.col("text").cast("binary")).alias("key"), F.length("text").alias("chars"))
    t = d.select("key", F.col("doc_id").alias("position"), "chars")
    cache = d.filter("doc_id % 3 = 0").select("key").distinct()
    first = t.groupBy("key").agg(F.min("position").alias("p"))
    pending = first.filter("p % 4 > 0").select("key", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p") % 9).cast("int")).alias("since"))
    return _text(memory.pending_plan(t, cache, pending, TODAY, 40_000))


@query("isolated_venues", "WITH b AS (SELECT DISTINCT l_suppkey AS venue FROM lineitem WHERE l_discount > 0.09 AND l_quantity > 49) SELECT l_suppkey AS venue, count(*) FILTER (l_orderkey % 2 = 0) AS n, 'primary' AS source FROM lineitem WHERE l_suppkey NOT IN (SELECT venue FROM b) GROUP BY 1 UNION ALL SELECT l_suppkey, count(*) FILTER (l_orderkey % 2 = 1), 'fallback' FROM lineitem WHERE l_suppkey IN (SELECT venue FROM b) GROUP BY 1")
def isolated_venues(spark, sf):
    l = table(spark, sf, "lineitem")

    def side(r, name):
        return l.groupBy(F.col("l_suppkey").alias("venue")).agg(F.count_if(F.col("l_orderkey") % 2 == r).alias("n"), F.lit(name).alias("source"))

    bad = l.filter("l_discount > 0.09 and l_quantity > 49").select(F.col("l_suppkey").alias("venue"), F.lit("odd").alias("problem"))
    return memory.isolated(side(0, "primary"), side(1, "fallback"), lambda _: bad)[0]


@query("coverage_baseline", "WITH p AS (SELECT source AS kind, 60.0 + count(*) % 40 AS b FROM documents WHERE doc_id % 3 = 0 GROUP BY 1), n AS (SELECT source AS kind, count(*) AS n, count(*) FILTER (n_chars > 400) AS c FROM documents GROUP BY 1) SELECT coalesce(p.kind, n.kind) AS kind, round(greatest(CASE WHEN n >= 12 THEN b - 0.5 ELSE b END, CASE WHEN n >= 12 THEN 100.0 * c / n END), 2) AS baseline FROM p FULL JOIN n ON p.kind = n.kind WHERE coalesce(b, CASE WHEN n >= 12 THEN 1 END) IS NOT NULL")
def coverage_baseline(spark, sf):
    d = table(spark, sf, "documents").withColumnRenamed("source", "kind")
    p = d.filter("doc_id % 3 = 0").groupBy("kind").agg((F.count(F.lit(1)) % 40 + 60.0).alias("baseline"))
    n = d.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") > 400).alias("covered"), F.lit(12).alias("least"))
    return memory.baseline(p, n, True)


_SHA = "sha1(user_id::VARCHAR)"


@query("deploy_decisions", f"""SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'skip' WHEN c IS NULL THEN 'skip' WHEN c = 'failure' THEN CASE WHEN user_id % 5 BETWEEN 1 AND 2 THEN 'retry' ELSE 'fail' END WHEN c NOT IN ('success', 'none') THEN 'fail' WHEN event_id % 13 = 0 THEN 'fail' WHEN event_id % 3 = 0 THEN 'ok' WHEN event_id % 2 = 0 THEN 'verify' ELSE 'fail' END AS decision
FROM (SELECT *, CASE event_type WHEN 'view' THEN 'success' WHEN 'click' THEN 'failure' WHEN 'error' THEN 'neutral' WHEN 'signup' THEN 'none' END AS c FROM events)""")
def deploy_decisions(spark, sf):
    k, sha = F.col("event_id"), F.sha1(F.col("user_id").cast("string").cast("binary"))
    t = F.col("event_type")
    d = table(spark, sf, "events").select(
        "event_id", sha.alias("run_sha"), F.when(k % 11 == 0, F.lit("f" * 40)).otherwise(sha).alias("main_sha"), F.when(t == "view", "success").when(t == "click", "failure").when(t == "error", "neutral").when(t == "signup", "none").alias("conclusion"),
        (F.col("user_id") % 5).alias("attempt"), F.when(k % 3 == 0, "s1").when(k % 5 > 0, "s0").alias("live_stamp"), F.when(k % 13 > 0, "s1").alias("committed_stamp"), (k % 2 == 1).alias("last_check"))
    return d.select("event_id", control.deploy_decision().alias("decision"))


# moments around both nights on which clocks change, and an ordinary winter day; local midnight's offset is 2 hours from the last Sunday of October to that of March, else 3
_NOW = "CASE event_id % 3 WHEN 0 THEN epoch(TIMESTAMP '2026-03-29 00:00:00') WHEN 1 THEN epoch(TIMESTAMP '2026-10-25 00:00:00') ELSE epoch(TIMESTAMP '2026-12-05 00:00:00') END::BIGINT + (event_id * 613) % 86400 - 10800"
_OFF = "(CASE WHEN {0} >= epoch(TIMESTAMP '2026-03-29 01:00:00') AND {0} < epoch(TIMESTAMP '2026-10-25 01:00:00') THEN 10800 ELSE 7200 END)"


def _wall(day, minutes):
    # 03:05 and 03:00 come after the change in spring, where they don't exist and move an hour on, and before it in autumn
    return f"(epoch({day}::TIMESTAMP)::BIGINT + {minutes} * 60 - CASE WHEN {day} = DATE '2026-03-29' THEN CASE WHEN {minutes} < 180 THEN 7200 WHEN {minutes} < 240 THEN 7200 ELSE 10800 END WHEN {day} > DATE '2026-03-29' AND {day} < DATE '2026-10-25' THEN 10800 WHEN {day} = DATE '2026-10-25' THEN CASE WHEN {minutes} < 240 THEN 10800 ELSE 7200 END ELSE 7200 END)"


@query("refresh_decisions", f"""WITH e AS (SELECT event_id, event_type, {_NOW} AS now, ({_NOW}) - (user_id % 30) * 3600 AS last FROM events), d AS (SELECT *, to_timestamp(now + {_OFF.format('now')})::TIMESTAMP::DATE AS day FROM e), x AS (SELECT *, {_wall('day', 185)} AS at185, {_wall('day', 1275)} AS eve, {_wall('day', 180)} AS done, {_wall('(day + 1)', 185)} - now AS tom FROM d)
SELECT event_id, CASE WHEN event_type = 'signup' THEN 'run' WHEN now < at185 THEN 'wait' WHEN now < eve THEN CASE WHEN last >= done THEN 'skip' ELSE 'run' END WHEN tom > 21000 THEN 'skip' ELSE 'wait' END AS decision, CASE WHEN event_type = 'signup' THEN 0 WHEN now < at185 THEN at185 - now WHEN now >= eve AND tom <= 21000 THEN tom ELSE 0 END AS seconds FROM x""")
def refresh_decisions(spark, sf):
    k = F.col("event_id")
    base = F.when(k % 3 == 0, 1774742400).when(k % 3 == 1, 1792886400).otherwise(1796428800)
    now = base + (k * 613) % 86400 - 10800
    d = table(spark, sf, "events").select("event_id", now.alias("now"), (now - (F.col("user_id") % 30) * 3600).alias("last"), F.when(F.col("event_type") == "signup", "manual").otherwise("schedule").alias("event"))
    what, wait = control.refresh_decision(F.col("now"), F.col("last"), F.col("event"))
    return d.select("event_id", what.alias("decision"), wait.alias("seconds"))


@query("other_waiters", "WITH r AS (SELECT event_id AS id, epoch(ts)::BIGINT AS started FROM events), me AS (SELECT id, CASE WHEN id % 4 > 0 THEN started END AS started, started + 60 AS now FROM r WHERE id % 50 = 0) SELECT me.id, EXISTS (SELECT 1 FROM r WHERE r.id <> me.id AND r.started > me.now - 900 AND r.started <= coalesce(me.started, me.now) - 180) AS covered FROM me")
def other_waiters(spark, sf):
    r = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("started"))
    me = r.filter("id % 50 = 0").select("id", F.when(F.col("id") % 4 > 0, F.col("started")).alias("started"), (F.col("started") + 60).alias("now"))
    return control.other_waiter(r, me, 180, 900)


_COV = "c AS (SELECT source AS kind, count(*) AS n, count(*) FILTER (n_chars {}) AS covered FROM documents GROUP BY 1)"


def _cov(spark, sf, least):
    return table(spark, sf, "documents").groupBy(F.col("source").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") >= least).alias("covered"))


@query("below_triggers", f"WITH {_COV.format('>= 150')} SELECT kind FROM c WHERE 100.0 * covered < 95.0 * n")
def below_triggers(spark, sf):
    return control.below_trigger(_cov(spark, sf, 150))


@query("fix_needed", f"WITH {_COV.format('>= 150')} SELECT count(*) > 0 AS needed FROM c WHERE 100.0 * covered < 95.0 * n")
def fix_needed(spark, sf):
    return control.fix_needed(_cov(spark, sf, 150))


@query("health_records", f"WITH {_COV.format('>= 150')}, b AS (SELECT kind, n, covered FROM (SELECT source AS kind, count(*) AS n, count(*) FILTER (n_chars >= 400) AS covered FROM documents GROUP BY 1)) SELECT c.kind, c.n, c.covered, round(100.0 * c.covered / c.n, 1) AS pct, round(100.0 * b.covered / b.n, 1) AS pct_before, 100.0 * c.covered < 95.0 * c.n AS below_target FROM c JOIN b USING (kind)")
def health_records(spark, sf):
    return control.health_record(_cov(spark, sf, 400), _cov(spark, sf, 150))


@query("picture_causes", """SELECT event_id, CASE event_id % 13 WHEN 0 THEN 'file changed' WHEN 1 THEN 'aggregator''s image' WHEN 2 THEN 'pending' WHEN 3 THEN 'no link' WHEN 4 THEN 'ticket pages only' WHEN 5 THEN 'robots.txt unreachable' WHEN 6 THEN 'blocked' WHEN 7 THEN 'fetch failed' WHEN 8 THEN 'not read' WHEN 9 THEN 'no image' WHEN 10 THEN 'not the title''s page' WHEN 11 THEN 'rejected' ELSE 'no image' END AS cause FROM events""")
def picture_causes(spark, sf):
    m = F.col("event_id") % 13
    note = F.when(m == 10, "the page does not: do not name the title").when(m == 11, "x: rejected, too small").when(m == 12, "no usable image on the page")
    d = table(spark, sf, "events").select(
        "event_id", (m == 0).alias("changed"), (m == 1).alias("aggregator"), F.when(m == 2, 1).alias("pending_days"), F.lit(3).alias("held_days"), F.when(m == 3, 0).otherwise(1).alias("links"), F.when(m == 4, 0).otherwise(1).alias("readable"),
        F.when(m == 5, "robots: unreachable").when(m == 6, "blocked: challenge").when(m == 7, "failed: 503").when(m == 9, "ok").alias("outcome"), F.when(note.isNotNull(), F.array(note)).otherwise(F.expr("cast(array() as array<string>)")).alias("notes"))
    return d.select("event_id", control.diagnosis().alias("cause"))


@query("fix_todo", f"WITH t AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'show' ELSE 'film' END AS kind, p_partkey % 3 > 0 AS missing, p_partkey % 5 AS readable, p_partkey % 7 = 0 AS failed, CASE WHEN p_partkey % 4 = 0 THEN {_T} END AS last, p_size % 8 AS rejected, CASE WHEN p_partkey % 6 = 0 THEN {_T} - CAST(p_size % 6 AS INTEGER) END AS pending FROM part), g AS (SELECT *, CASE WHEN missing AND readable > 0 AND NOT (coalesce(last = {_T}, false) AND NOT failed AND rejected < 5) THEN CASE WHEN failed THEN 0 ELSE 1 END WHEN {_T} - pending >= 3 THEN 2 END AS place FROM t) SELECT kind, id, place FROM g WHERE place IS NOT NULL ORDER BY place, kind DESC, id LIMIT 120")
def fix_todo(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    t = F.lit(TODAY).cast("date")
    d = p.select(k.alias("id"), F.when(k % 2 == 0, "show").otherwise("film").alias("kind"), (k % 3 > 0).alias("missing"), (k % 5).alias("readable"), (k % 7 == 0).alias("failed"), F.when(k % 4 == 0, t).alias("last"), (F.col("p_size") % 8).alias("rejected"), F.when(k % 6 == 0, F.date_sub(t, F.col("p_size") % 6)).alias("pending"))
    return control.todo(d, TODAY, 120)


@query("balanced_shards")
def balanced_shards(spark, sf):
    d = table(spark, sf, "orders").select((F.col("o_custkey") % 20).alias("group"), F.col("o_orderkey").alias("position"), F.col("o_orderkey").alias("item"), F.floor(F.col("o_totalprice") / 1000).cast("long").alias("seconds"))
    return control.shards(d, 3000)


_ATT = "a AS (SELECT user_id AS host, event_type AS url, event_id AS pos, CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 4 = 0 THEN NULL ELSE 503 END ELSE 200 END AS status, event_id % 30 AS seconds, event_id % 17 = 0 AS challenge FROM events)"


def _attempts(spark, sf):
    k = F.col("event_id")
    return table(spark, sf, "events").select(F.col("user_id").alias("host"), F.col("event_type").alias("url"), k.alias("position"), F.when(F.col("event_type") == "error", F.when(k % 4 > 0, 503)).otherwise(200).alias("status"), (k % 30).cast("double").alias("seconds"), (k % 17 == 0).alias("challenge"))


@query("fetch_verdicts", f"WITH {_ATT}, w AS (SELECT *, coalesce(sum((status IS NULL OR status >= 400)::INT) OVER h, 0) AS bad, coalesce(sum(seconds) OVER h, 0) AS spent, coalesce(sum(seconds) OVER u, 0) AS mine FROM a WINDOW h AS (PARTITION BY host ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), u AS (PARTITION BY host, url ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT host, url, pos AS position, CASE WHEN spent >= 420 THEN 'over budget' WHEN bad >= 2 THEN 'host closed' WHEN mine >= 75 THEN 'over budget' WHEN challenge THEN 'blocked' WHEN status IS NULL OR status >= 400 THEN 'failed' ELSE 'ok' END AS verdict FROM w")
def fetch_verdicts(spark, sf):
    return control.fetch_verdicts(_attempts(spark, sf))


@query("host_summaries", f"WITH {_ATT} SELECT host, count(*) AS requests, count(*) FILTER (status IS NULL OR status >= 400) AS failures, round(sum(seconds), 2)::DOUBLE AS seconds FROM a GROUP BY 1")
def host_summaries(spark, sf):
    return control.host_summary(_attempts(spark, sf))


@query("run_flags", "WITH s AS (SELECT s_suppkey AS venue FROM supplier) SELECT 'warning' AS level, venue, 'own programme not read, a reseller''s ' || (venue % 9) || ' rows stand in' AS message FROM s WHERE venue % 5 = 0 UNION ALL SELECT 'warning', venue, 'next month not judged: only 3 known day(s) before it' FROM s WHERE venue % 4 = 1 UNION ALL SELECT 'warning', venue, 'times off the grid: 1998-06-01 12:13; 1998-06-02 12:13' FROM s WHERE venue % 6 = 2 UNION ALL SELECT 'warning', venue, (1 + venue % 3) || ' times differ from the kept rows' FROM s WHERE venue % 7 = 3")
def run_flags(spark, sf):
    s, v = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("venue")), F.col("venue")
    odd = s.filter(v % 6 == 2).select("venue", F.explode(F.array(*[F.lit(d).cast("date") for d in ("1998-06-02", "1998-06-01")])).alias("date"), F.lit("12:13").alias("time"))
    clash = s.filter(v % 7 == 3).select("venue", F.explode(F.sequence(F.lit(0), (v % 3).cast("int"))).alias("i"))
    notes = s.filter(v % 4 < 2).select("venue", F.when(v % 4 == 1, "only 3 known day(s) before it").otherwise("fine").alias("note"))
    return control.run_flags(s.filter(v % 5 == 0).select("venue", (v % 9).alias("n")), notes, odd, clash)


@query("upcoming_counts", "WITH c AS (SELECT l_suppkey % 20 AS venue, l_partkey, l_shipdate, l_linenumber FROM lineitem WHERE l_orderkey % 2 = 0 AND l_shipdate >= '1998-06-01' GROUP BY ALL), p AS (SELECT o_custkey % 20 AS venue FROM orders WHERE o_orderdate >= '1998-06-01') SELECT venue, sum(n)::BIGINT AS n FROM (SELECT venue, count(*) AS n FROM c GROUP BY 1 UNION ALL SELECT venue, count(*) FROM p GROUP BY 1) GROUP BY 1")
def upcoming_counts(spark, sf):
    l = table(spark, sf, "lineitem").filter("l_orderkey % 2 = 0").groupBy((F.col("l_suppkey") % 20).alias("venue"), "l_partkey", F.col("l_shipdate").cast("date").alias("date")).agg(F.collect_set("l_linenumber").alias("times"))
    p = table(spark, sf, "orders").select(F.col("o_custkey").alias("show"), F.col("o_orderdate").cast("date").alias("date"))
    shows = table(spark, sf, "orders").select(F.col("o_custkey").alias("show"), (F.col("o_custkey") % 20).alias("venue")).distinct()
    return control.upcoming_counts(l, p, shows, "1998-06-01")
