"""Quality, coverage and state queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import coverage, quality, scan, state
from plumbline.registry import query
from plumbline.session import table


def _cell(spark, sf, keep: str):
    d = table(spark, sf, "lineitem").filter(keep)
    return d.groupBy((F.col("l_suppkey") % 50).alias("venue"), (F.col("l_partkey") % 20).alias("item")).agg(F.max("l_linenumber").cast("long").alias("value"))


_CELL = "(SELECT l_suppkey % 50 AS venue, l_partkey % 20 AS item, max(l_linenumber) AS value FROM lineitem WHERE {} GROUP BY 1, 2)"
# two snapshots: what was shipped by two days
_OLD, _NEW = "l_shipdate < '1998-06-01'", "l_shipdate < '1998-09-01' and not (l_suppkey % 7 = 3 and l_partkey % 3 = 1)"


@query("snapshot_diff", f"""WITH a AS {_CELL.format(_OLD)}, b AS {_CELL.format(_NEW)}, r AS (SELECT DISTINCT venue FROM b WHERE venue % 4 <> 1),
d AS (SELECT coalesce(a.venue, b.venue) AS venue, coalesce(a.item, b.item) AS item, a.value AS old, b.value AS new FROM a FULL JOIN b ON a.venue = b.venue AND a.item = b.item)
SELECT * FROM (SELECT *, CASE WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN CASE WHEN venue IN (SELECT venue FROM r) THEN 'removed' END WHEN old <> new THEN 'changed' END AS change FROM d) WHERE change IS NOT NULL""")
def snapshot_diff(spark, sf):
    new = _cell(spark, sf, _NEW)
    return quality.snapshot_diff(_cell(spark, sf, _OLD), new, ["venue", "item"], "value", new.filter("venue % 4 <> 1"), "venue")


@query("set_equal_check", f"""WITH a AS {_CELL.format(_OLD)}, b AS {_CELL.format(_NEW)}
SELECT venue, sum(m)::BIGINT AS missing, sum(e)::BIGINT AS extra FROM (SELECT venue, 1 AS m, 0 AS e FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT venue, 0, 1 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) GROUP BY 1""")
def set_equal_check(spark, sf):
    return quality.set_difference(_cell(spark, sf, _OLD), _cell(spark, sf, _NEW), ["venue"])


@query("implausible_drop", """WITH a AS (SELECT o_custkey % 60 AS k, count(*) / 30.0 AS before FROM orders WHERE o_orderdate >= '1998-05-01' AND o_orderdate < '1998-05-31' GROUP BY 1), b AS (SELECT o_custkey % 60 AS k, count(*) / 30.0 AS now FROM orders WHERE o_orderdate >= '1998-06-01' AND o_orderdate < '1998-07-01' GROUP BY 1)
SELECT * FROM (SELECT a.k, before, coalesce(now, 0) AS now FROM a LEFT JOIN b ON a.k = b.k) WHERE now < 0.25 * before""")
def implausible_drop(spark, sf):
    def run(first, last):
        d = table(spark, sf, "orders").filter(F.col("o_orderdate").cast("date").between(first, last))
        return d.groupBy((F.col("o_custkey") % 60).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.lit(30).alias("days"))

    return quality.implausible_drops(run("1998-05-01", "1998-05-30"), run("1998-06-01", "1998-06-30"), "k")


_CHECKS = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("labels", "doc_id", "documents", "doc_id"), ("nation", "n_regionkey", "region", "r_regionkey")]


@query("gate_integrity", " UNION ALL ".join(f"SELECT '{c}.{ck}' AS check_name, (SELECT count(*) FROM {c} WHERE {ck} NOT IN (SELECT {pk} FROM {p})) AS orphans, (SELECT count(*) - count(DISTINCT {pk}) FROM {p}) AS duplicates, (SELECT count(*) FROM {c}) AS n_rows" for c, ck, p, pk in _CHECKS))
def gate_integrity(spark, sf):
    out = None
    for c, ck, p, pk in _CHECKS:
        d = quality.integrity(table(spark, sf, c), ck, table(spark, sf, p), pk, f"{c}.{ck}")
        out = d if out is None else out.unionByName(d)
    return out


_COUNTS = """v AS (SELECT l_suppkey % 50 AS venue, count(*) FILTER (l_shipdate >= '1998-06-01' AND l_shipdate < '1998-06-08' AND l_suppkey % 11 <> 2) AS now, count(*) FILTER (l_shipdate >= '1998-05-01' AND l_shipdate < '1998-05-08') AS prev, CASE WHEN l_suppkey % 50 % 17 = 3 THEN 'unreachable' WHEN l_suppkey % 50 % 13 = 4 THEN 'preliminary' ELSE 'ok' END AS status FROM lineitem GROUP BY 1, 4)"""


@query("health_report", f"""WITH {_COUNTS} SELECT venue, 0 AS rank, 'error' AS level, 'unreachable' AS message FROM v WHERE status = 'unreachable' UNION ALL SELECT venue, 1, 'error', 'emptied' FROM v WHERE now = 0 AND prev > 0
UNION ALL SELECT venue, 2, 'warning', 'low count' FROM v WHERE now > 0 AND now < 0.25 * prev UNION ALL SELECT venue, 3, 'warning', 'preliminary' FROM v WHERE status = 'preliminary'""")
def health_report(spark, sf):
    d, k = F.col("l_shipdate").cast("date"), F.col("l_suppkey") % 50
    status = F.when(k % 17 == 3, "unreachable").when(k % 13 == 4, "preliminary").otherwise("ok")
    rows = table(spark, sf, "lineitem").groupBy(k.alias("venue"), status.alias("status")).agg(F.count_if(d.between("1998-06-01", "1998-06-07") & (F.col("l_suppkey") % 11 != 2)).alias("now"), F.count_if(d.between("1998-05-01", "1998-05-07")).alias("prev"))
    return quality.health_report(rows)


@query("lost_scores", """SELECT source, count(*) AS lost FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1 AND d.doc_id % 3 = 0 GROUP BY 1 HAVING count(*) >= 3""")
def lost_scores(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("doc_id", "source", "quality")
    old = d.withColumn("score", F.when(F.col("quality") == 1, 1))
    return quality.lost_scores(old, old.withColumn("score", F.when(F.col("doc_id") % 3 != 0, F.col("score"))), "doc_id", "source", "score")


_LABELLED = "(SELECT d.doc_id, source, lang, n_chars, quality, toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


def _labelled(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", "text").join(table(spark, sf, "labels"), "doc_id", "left")


@query("coverage_by_group", f"SELECT source, count(*) AS n, count(quality) AS covered, count(*) - count(quality) AS missing, round(100.0 * count(quality) / count(*), 1) AS pct FROM {_LABELLED} GROUP BY ROLLUP (source)")
def coverage_by_group(spark, sf):
    return coverage.coverage(_labelled(spark, sf), "source", F.col("quality").isNotNull())


@query("coverage_causes", f"""SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, cause) AS rank FROM (SELECT lang, CASE WHEN quality IS NOT NULL THEN NULL WHEN n_chars < 200 THEN 'too short' WHEN n_chars > 8000 THEN 'too long' ELSE 'not looked up' END AS cause, count(*) AS n FROM {_LABELLED} GROUP BY 1, 2) WHERE cause IS NOT NULL""")
def coverage_causes(spark, sf):
    cause = F.when(F.col("quality").isNotNull(), None).when(F.col("n_chars") < 200, "too short").when(F.col("n_chars") > 8000, "too long").otherwise("not looked up")
    return coverage.causes(_labelled(spark, sf), "lang", cause)


@query("coverage_gate", f"""WITH m AS (SELECT source, round(100.0 * count(*) FILTER (n_chars >= 150) / count(*), 1) AS pct, 80.0 + hash_k AS baseline FROM (SELECT *, CAST(substr(source, 4) AS INTEGER) AS hash_k FROM {_LABELLED}) GROUP BY source, hash_k)
SELECT *, CASE WHEN pct < 90 THEN 'fail: floor' WHEN baseline - pct >= 15 THEN 'fail: collapse' WHEN pct < 95 THEN 'warn: bar' WHEN baseline - pct >= 3 THEN 'warn: drift' ELSE 'ok' END AS verdict FROM m""")
def coverage_gate(spark, sf):
    d = _labelled(spark, sf).groupBy("source").agg(F.round(100.0 * F.count_if(F.col("n_chars") >= 150) / F.count(F.lit(1)), 1).alias("pct"))
    return quality.coverage_gate(d.withColumn("baseline", F.expr("80.0D + cast(substr(source, 4) as int)")))


@query("ratings_coverage", f"""WITH one AS (SELECT CASE WHEN doc_id % 4 > 0 THEN 'e' || (doc_id % 400)::VARCHAR ELSE 'o' || doc_id::VARCHAR END AS k, min(source) AS source, max(quality) AS quality, max(toxic) AS toxic FROM {_LABELLED} GROUP BY 1)
SELECT source, count(*) AS n, sum(coalesce(quality, 0))::BIGINT AS quality, sum(coalesce(toxic, 0))::BIGINT AS toxic, sum(coalesce(greatest(quality, toxic), 0))::BIGINT AS any_source FROM one GROUP BY 1""")
def ratings_coverage(spark, sf):
    d = _labelled(spark, sf).withColumn("external", F.when(F.col("doc_id") % 4 > 0, F.col("doc_id") % 400))
    return coverage.deduplicated_coverage(d, "external", "doc_id", ["quality", "toxic"], "source")


@query("broken_sources", f"""WITH g AS (SELECT doc_id % 100 AS grp, count(*) AS n, count(*) FILTER (quality = 1 AND toxic = 0) AS good, list_sort(list(DISTINCT CASE WHEN quality IS NULL THEN 'no label' WHEN quality = 0 THEN 'poor' WHEN toxic = 1 THEN 'toxic' ELSE 'fine' END)) AS causes FROM {_LABELLED} GROUP BY 1)
SELECT grp, n, array_to_string(causes, ',') AS causes FROM g WHERE n >= 8 AND good = 0 AND len(list_filter(causes, lambda x: x NOT IN ('no label', 'poor'))) = 0""")
def broken_sources(spark, sf):
    cause = F.when(F.col("quality").isNull(), "no label").when(F.col("quality") == 0, "poor").when(F.col("toxic") == 1, "toxic").otherwise("fine")
    return coverage.broken_groups(_labelled(spark, sf).withColumn("grp", F.col("doc_id") % 100), "grp", F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False)), cause, 8, ["no label", "poor"])


_PRICES = "'from ' || p_size::VARCHAR || '.50 EUR to ' || (p_partkey % 90)::VARCHAR || ',05 EUR ' || p_name"


@query("price_range", f"""WITH t AS (SELECT p_partkey, list_transform(regexp_extract_all({_PRICES}, '[0-9]+[.,][0-9]{{2}} EUR'), lambda x: CAST(regexp_extract(x, '([0-9]+)[.,]([0-9]{{2}}) EUR', 1) AS BIGINT) * 100 + CAST(regexp_extract(x, '([0-9]+)[.,]([0-9]{{2}}) EUR', 2) AS BIGINT)) AS a FROM part)
SELECT p_partkey, list_min(a) AS low, list_max(a) AS high FROM t""")
def price_range(spark, sf):
    text = F.concat(F.lit("from "), F.col("p_size").cast("string"), F.lit(".50 EUR to "), (F.col("p_partkey") % 90).cast("string"), F.lit(",05 EUR "), F.col("p_name"))
    low, high = coverage.price_range(F.col("text"))
    return table(spark, sf, "part").select("p_partkey", text.alias("text")).select("p_partkey", low.alias("low"), high.alias("high"))


@query("budget_prefix", """SELECT doc_id, source, n_chars, total FROM (SELECT *, sum(n_chars) OVER w AS total, row_number() OVER w AS n FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id DESC ROWS UNBOUNDED PRECEDING)) WHERE total <= 20000 OR n = 1""")
def budget_prefix(spark, sf):
    return state.budget_prefix(table(spark, sf, "documents").select("doc_id", "source", "n_chars"), "source", [F.desc("doc_id")], "n_chars", 20000)


_HOST = "regexp_extract(url, '://([^/?#]*)', 1)"


@query("round_robin_plan", f"SELECT * FROM (SELECT page_id, {_HOST} AS host, row_number() OVER (PARTITION BY {_HOST} ORDER BY page_id) AS turn FROM pages) WHERE turn <= 2")
def round_robin_plan(spark, sf):
    return state.round_robin(table(spark, sf, "pages").select("page_id", F.regexp_extract("url", "://([^/?#]*)", 1).alias("host")), "host", ["page_id"], 2)


@query("topn_per_group", "SELECT * FROM (SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem) WHERE rank <= 3")
def topn_per_group(spark, sf):
    d = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return state.top_n(d, "l_suppkey", [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"], 3).drop("l_partkey")


@query("due_schedule", """WITH s AS (SELECT user_id, max(ts)::DATE AS checked, bool_and(event_type <> 'error') AS ok, max(event_type) AS url, min(event_type) AS checked_url FROM (SELECT ts, event_type, event_id // 4 AS user_id FROM events) GROUP BY 1)
SELECT * FROM (SELECT user_id, CASE WHEN checked IS NULL THEN 'never' WHEN url IS DISTINCT FROM checked_url THEN 'changed' WHEN ok AND DATE '2024-02-01' - checked >= 7 THEN 'recheck' WHEN NOT ok AND DATE '2024-02-01' - checked >= 3 THEN 'retry' END AS reason FROM s) WHERE reason IS NOT NULL""")
def due_schedule(spark, sf):
    s = table(spark, sf, "events").groupBy(F.expr("event_id div 4").alias("user_id")).agg(F.max("ts").cast("date").alias("checked"), F.bool_and(F.col("event_type") != "error").alias("ok"), F.max("event_type").alias("url"), F.min("event_type").alias("checked_url"))
    return state.due(s, "2024-02-01", 7, 3).select("user_id", "reason")


@query("hash_cache_missing", "SELECT sha1(text) AS key, max(length(text)) AS n FROM documents WHERE sha1(text) NOT IN (SELECT sha1(text) FROM documents WHERE doc_id % 3 = 0) GROUP BY 1")
def hash_cache_missing(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    cache = d.filter("doc_id % 3 = 0").select(F.sha1(F.col("text").cast("binary")).alias("key")).distinct()
    return state.missing_from_cache(d, cache, "text").select("key", F.length("text").alias("n"))


@query("batch_next_fit", """WITH RECURSIVE d AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
r AS (SELECT source, doc_id, n_chars, i, 0::BIGINT AS batch, 1 AS held, n_chars AS total FROM d WHERE i = 1
UNION ALL SELECT d.source, d.doc_id, d.n_chars, d.i, CASE WHEN held = 8 OR total + d.n_chars > 20000 THEN batch + 1 ELSE batch END, CASE WHEN held = 8 OR total + d.n_chars > 20000 THEN 1 ELSE held + 1 END, CASE WHEN held = 8 OR total + d.n_chars > 20000 THEN d.n_chars ELSE total + d.n_chars END FROM r JOIN d ON d.source = r.source AND d.i = r.i + 1)
SELECT source, doc_id, n_chars, batch FROM r""")
def batch_next_fit(spark, sf):
    return scan.next_fit(table(spark, sf, "documents"), "source", "doc_id", "n_chars", 8, 20_000)


@query("leader_cluster")
def leader_cluster(spark, sf):
    d = table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("tokens")).withColumn("grp", F.col("user_id") % 8)
    return state.leader_clusters(d, "grp", "user_id", "tokens", 4)


@query("override_precedence", """SELECT doc_id, coalesce(CASE WHEN length(trim(a)) >= 400 THEN trim(a) END, CASE WHEN length(trim(b)) >= 2 THEN trim(b) END, CASE WHEN length(trim(c)) >= 1 THEN trim(c) END) AS chosen FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text END AS a, CASE WHEN doc_id % 2 = 0 THEN lang END AS b, source AS c FROM documents)""")
def override_precedence(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("text")).alias("a"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("b"), F.col("source").alias("c"))
    return d.select("doc_id", state.override([("a", 400), ("b", 2), ("c", 1)]).alias("chosen"))


@query("settle_counters", """WITH p AS (SELECT user_id, user_id % 3 AS misses, '2024-01-01' AS last_ok FROM events WHERE user_id % 2 = 0 GROUP BY 1), o AS (SELECT user_id, max(event_type) <> 'view' AS ok, CAST(max(ts)::DATE AS VARCHAR) AS seen FROM events WHERE user_id % 5 > 0 GROUP BY 1)
SELECT coalesce(p.user_id, o.user_id) AS user_id, CASE WHEN ok THEN 0 WHEN NOT ok THEN coalesce(misses, 0) + 1 ELSE misses END AS misses, CASE WHEN ok THEN seen ELSE last_ok END AS last_ok FROM p FULL JOIN o ON p.user_id = o.user_id""")
def settle_counters(spark, sf):
    e = table(spark, sf, "events")
    p = e.filter("user_id % 2 = 0").select("user_id", (F.col("user_id") % 3).alias("misses"), F.lit("2024-01-01").alias("last_ok")).distinct()
    o = e.filter("user_id % 5 > 0").groupBy("user_id").agg((F.max("event_type") != "view").alias("ok"), F.max("ts").cast("date").cast("string").alias("at"))
    return state.settle(p, o, "user_id")
