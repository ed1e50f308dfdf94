"""Filling, gates, reports and page extraction."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plumbline import sources
from plumbline.functions import html, listing
from plumbline.operators import control, duplicates, events, graph, identity, serving
from plumbline.registry import query
from plumbline.session import table


def _text(d):
    return d.withColumns({c: F.col(c).cast("string") for c, t in d.dtypes if t == "date"})


def _p(spark, sf):
    return table(spark, sf, "part"), F.col("p_partkey")


@query("seed_wins", "SELECT p_partkey AS id FROM part WHERE p_partkey % 3 <> 0 AND NOT (p_partkey % 4 = 1 AND p_size > 25)")
def seed_wins(spark, sf):
    p, k = _p(spark, sf)
    d = p.select(k.alias("id"), "p_size")
    return serving.seed_wins(d.select("id"), d.filter("id % 3 = 0").select("id"), d.filter("id % 4 = 1 and p_size > 25").select("id"))


_FACTS = "SELECT l_partkey AS id, CASE WHEN l_orderkey % 3 > 0 THEN 90 + l_partkey % 40 + l_orderkey % 3 END AS runtime, CASE WHEN l_orderkey % 4 > 0 THEN 1990 + l_partkey % 30 + CASE WHEN l_partkey % 5 = 0 THEN l_orderkey % 2 ELSE 0 END END AS year FROM lineitem"


@query("agreed_facts", f"""WITH r AS ({_FACTS}), rt AS (SELECT id, runtime AS v, count(*) AS n FROM r WHERE runtime IS NOT NULL GROUP BY 1, 2), y AS (SELECT id, min(year) AS v FROM r WHERE year IS NOT NULL GROUP BY 1 HAVING min(year) = max(year)),
m AS (SELECT id, v FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, v) AS i, max(v) OVER (PARTITION BY id) - min(v) OVER (PARTITION BY id) AS gap FROM rt) WHERE i = 1 AND gap <= 3)
SELECT p_partkey AS id, coalesce(CASE WHEN p_partkey % 2 = 0 THEN 100 END, m.v) AS runtime, coalesce(CASE WHEN p_partkey % 7 = 0 THEN 1980 END, y.v) AS year FROM part LEFT JOIN m ON m.id = p_partkey LEFT JOIN y ON y.id = p_partkey""")
def agreed_facts(spark, sf):
    l, k, o = table(spark, sf, "lineitem"), F.col("l_partkey"), F.col("l_orderkey")
    rows = l.select(k.alias("id"), F.when(o % 3 > 0, k % 40 + 90 + o % 3).alias("runtime"), F.when(o % 4 > 0, k % 30 + 1990 + F.when(k % 5 == 0, o % 2).otherwise(0)).alias("year"))
    p, k = _p(spark, sf)
    return serving.agreed_facts(p.select(k.alias("id"), F.when(k % 2 == 0, 100).alias("runtime"), F.when(k % 7 == 0, 1980).alias("year")), rows)


@query("minted_listings", """WITH r AS (SELECT p_size % 4 AS theatre, p_name || ' ' || lower(p_type) AS k, p_partkey AS n, DATE '1998-06-01' + CAST(p_partkey % 60 AS INTEGER) AS date FROM part), w AS (SELECT * FROM r WHERE date BETWEEN DATE '1998-06-10' AND DATE '1998-07-10' AND n % 9 > 0 AND (theatre, k) NOT IN (SELECT (theatre, k) FROM r WHERE n % 5 = 0) AND (theatre, k) NOT IN (SELECT (theatre, k) FROM r WHERE n % 7 = 0))
SELECT theatre, k AS key, CASE WHEN bool_and(n % 3 = 1) THEN upper(k) ELSE k END AS display, arg_min('u' || n, (date, n)) AS page FROM w GROUP BY 1, 2""")
def minted_listings(spark, sf):
    p, k = _p(spark, sf)
    name = F.concat("p_name", F.lit(" "), F.lower("p_type"))
    title = F.when(k % 3 == 1, F.concat(F.upper(name), F.lit(" | ПРЕМИЕРА"))).otherwise(F.concat(F.lit("„"), name, F.lit("“")))
    r = p.select((F.col("p_size") % 4).alias("theatre"), F.when(k % 9 == 0, F.concat(title, F.lit(" гостува в друг театър"))).otherwise(title).alias("title"), F.date_add(F.lit("1998-06-01").cast("date"), (k % 60).cast("int")).alias("date"), k.alias("time"), F.concat(F.lit("u"), k.cast("string")).alias("page"), name.alias("key"))
    known = [r.filter(F.col("time") % n == 0).select("theatre", "key") for n in (5, 7)]
    return serving.mint_listed(r.drop("key"), *known, "1998-06-10", "1998-07-10")


@query("retitled_shows", "SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) || ' ПРЕМИЕРА' ELSE p_name END AS old, p_name AS new FROM part WHERE p_partkey % 2 = 0")
def retitled_shows(spark, sf):
    p, k = _p(spark, sf)
    m = p.select(k.alias("id"), F.when(k % 2 == 0, F.concat(F.upper("p_name"), F.lit(" ПРЕМИЕРА"))).otherwise(F.col("p_name")).alias("title"))
    s = p.select(k.alias("id"), F.concat(F.lit("\""), "p_name", F.lit("\"")).alias("title")).unionByName(p.select(k.alias("id"), F.upper("p_name").alias("title")))
    return serving.retitled(m, s)


@query("window_sanity", "SELECT count(*) FILTER (l_shipdate < '1998-06-01') AS before, count(*) FILTER (l_shipdate >= '1998-06-01' AND l_shipdate < '1998-08-07') AS inside, count(*) FILTER (l_shipdate >= '1998-08-07') AS after, true AS sane FROM lineitem")
def window_sanity(spark, sf):
    return serving.window_sanity(table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")), "1998-06-01", "1998-08-06")


@query("collapsed_tables", "SELECT name, n, floor FROM (SELECT 'nation' AS name, count(*) AS n, 30 AS floor FROM nation UNION ALL SELECT 'region', count(*), 5 FROM region UNION ALL SELECT 'supplier', count(*), 1000000000 FROM supplier) WHERE n < floor")
def collapsed_tables(spark, sf):
    counts = None
    for n in ("nation", "region", "supplier"):
        d = table(spark, sf, n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"))
        counts = d if counts is None else counts.unionByName(d)
    return serving.floors(counts, {"nation": 30, "region": 5, "supplier": 1_000_000_000})


@query("freshness", "SELECT event_id AS id, CASE WHEN event_id % 6 = 0 THEN 'missing' WHEN event_id % 6 = 1 THEN 'unreadable' WHEN epoch(TIMESTAMP '2024-01-20 00:00:00' - ts) > 36 * 3600 THEN 'old' WHEN event_id % 5 = 0 THEN 'empty' ELSE 'ok' END AS verdict FROM events")
def freshness(spark, sf):
    k = F.col("event_id")
    d = table(spark, sf, "events").select(k.alias("id"), F.when(k % 6 == 0, "").when(k % 6 == 1, "yesterday").otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))).alias("generated"), (k % 5).alias("upcoming"))
    return serving.freshness(d, "2024-01-20 00:00:00")


@query("shape_problems", "SELECT event_id, 'no k' AS problem FROM events WHERE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 UNION ALL SELECT event_id, 'odd type' FROM events WHERE event_type NOT IN ('view', 'click', 'error') UNION ALL SELECT event_id, 'small value' FROM events WHERE value < 1")
def shape_problems(spark, sf):
    return serving.shape_problems(table(spark, sf, "events"), "event_id", {"no k": "try_cast(get_json_object(props, '$.k') as int) < 50", "odd type": "event_type in ('view', 'click', 'error')", "small value": "value >= 1"})


@query("lost_by_source", "SELECT source, count(*) AS lost FROM (SELECT unnest(['a', 'b']) AS source, p_partkey AS k, p_size AS z FROM part WHERE p_partkey % 5 <> 0) WHERE (source = 'a' AND k % 2 = 0 AND z % 3 = 0) OR (source = 'b' AND k % 50 = 1) GROUP BY 1 HAVING count(*) >= 3")
def lost_by_source(spark, sf):
    p, k = _p(spark, sf)
    z = F.col("p_size")
    old = p.select(k.alias("id"), k.alias("match"), F.when(k % 2 == 0, 1.0).alias("a"), F.lit(2.0).alias("b"))
    new = p.select(k.alias("id"), F.when(k % 5 == 0, k + 1).otherwise(k).alias("match"), F.when((k % 2 == 0) & (z % 3 > 0), 1.0).alias("a"), F.when(k % 50 != 1, 2.0).alias("b"))
    return serving.lost_scores(old, new, ["a", "b"])


@query("joined_times", "SELECT coalesce(nullif(CASE WHEN l_orderkey % 3 = 0 THEN '' ELSE 'u' || (l_partkey % 50) END, ''), 't' || (l_partkey % 7)) AS key, l_shipdate::DATE::VARCHAR AS date, string_agg(DISTINCT (10 + l_linenumber) || ':00', ',' ORDER BY (10 + l_linenumber) || ':00') AS times FROM lineitem GROUP BY 1, 2")
def joined_times(spark, sf):
    l, k = table(spark, sf, "lineitem"), F.col("l_partkey")
    d = l.select(F.when(F.col("l_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("u"), (k % 50).cast("string"))).alias("link"), F.concat(F.lit("t"), (k % 7).cast("string")).alias("title"), F.col("l_shipdate").cast("date").alias("date"), F.concat((F.col("l_linenumber") + 10).cast("string"), F.lit(":00")).alias("time"))
    return _text(serving.joined_times(d))


@query("synopsis_measure", "SELECT source AS theatre, count(*) AS n, count(*) FILTER (s = 0) AS none, count(*) FILTER (s > 0 AND s < 280) AS thin, count(*) FILTER (s >= 280) AS \"full\" FROM (SELECT source, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE length(trim(text, ' ')) END AS s FROM documents) GROUP BY ROLLUP (source)")
def synopsis_measure(spark, sf):
    return serving.synopsis_measure(table(spark, sf, "documents").select(F.col("source").alias("theatre"), F.when(F.col("doc_id") % 9 > 0, F.col("text")).alias("text")))


@query("ratable_films", "SELECT grp AS \"group\", count(*) AS films, sum(a)::BIGINT AS \"any\", count(*) FILTER (a = 1 OR v > 0) AS ratable FROM (SELECT p_size % 5 AS grp, CASE WHEN p_partkey % 3 > 0 THEN 'm' || (p_partkey % 40) ELSE 'i' || p_partkey END AS k, max(greatest((p_partkey % 7 = 0)::INT, (p_partkey % 11 = 0)::INT)) AS a, max(CASE WHEN p_partkey % 4 = 0 THEN p_partkey ELSE 0 END) AS v FROM part GROUP BY 1, 2) GROUP BY 1")
def ratable_films(spark, sf):
    p, k = _p(spark, sf)
    d = p.select((F.col("p_size") % 5).alias("group"), k.alias("id"), F.when(k % 3 > 0, k % 40).alias("match"), F.when(k % 4 == 0, k).alias("votes"), (k % 7 == 0).alias("a"), F.when(k % 11 == 0, True).alias("b"))
    return serving.ratable(d, ["a", "b"])


@query("route_histogram", "SELECT lang AS route, CASE WHEN n_chars < 120 THEN 'short' WHEN n_chars < 280 THEN 'thin' ELSE 'full' END AS outcome, count(*) AS n FROM documents GROUP BY 1, 2")
def route_histogram(spark, sf):
    n = F.col("n_chars")
    return table(spark, sf, "documents").groupBy(F.col("lang").alias("route"), F.when(n < 120, "short").when(n < 280, "thin").otherwise("full").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("source_union", "SELECT l_partkey AS item, l_shipdate::DATE::VARCHAR AS date FROM lineitem WHERE l_orderkey % 3 = 0 UNION SELECT l_partkey, l_shipdate::DATE::VARCHAR FROM lineitem WHERE l_orderkey % 3 = 1")
def source_union(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("item"), F.col("l_shipdate").cast("date").cast("string").alias("date"), "l_orderkey")
    return d.filter("l_orderkey % 3 = 0").drop("l_orderkey").union(d.filter("l_orderkey % 3 = 1").drop("l_orderkey")).distinct()


@query("key_intersection", "SELECT l_suppkey, l_partkey % 100 AS item FROM lineitem WHERE l_linenumber = 1 INTERSECT SELECT l_suppkey, l_partkey % 100 FROM lineitem WHERE l_linenumber = 2")
def key_intersection(spark, sf):
    d = table(spark, sf, "lineitem").select("l_suppkey", (F.col("l_partkey") % 100).alias("item"), "l_linenumber")
    return d.filter("l_linenumber = 1").drop("l_linenumber").intersect(d.filter("l_linenumber = 2").drop("l_linenumber"))


@query("kept_union", "SELECT o_orderkey, 'fresh' AS source FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, 'previous' FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 > 0 AND o_orderkey % 5 > 0")
def kept_union(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    fresh, rejected = o.filter("o_orderkey % 3 = 0"), o.filter("o_orderkey % 5 = 0")
    old = o.filter("o_orderkey % 2 = 0").join(fresh, "o_orderkey", "left_anti").join(rejected, "o_orderkey", "left_anti")
    return fresh.withColumn("source", F.lit("fresh")).unionByName(old.withColumn("source", F.lit("previous")))


@query("state_round_trip", "SELECT DISTINCT l_partkey::VARCHAR AS film, l_suppkey::VARCHAR AS venue, l_shipdate::DATE::VARCHAR AS date, l_linenumber::VARCHAR AS time FROM lineitem")
def state_round_trip(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("film"), F.col("l_suppkey").alias("venue"), F.col("l_shipdate").cast("date").alias("date"), F.col("l_linenumber").alias("time"))
    return serving.round_trip(d, ["film", "venue", "date", "time"])[1]


@query("filled_details", "SELECT p_partkey AS id, CASE WHEN p_partkey % 3 > 0 AND p_partkey % 2 > 0 AND p_partkey % 5 > 0 THEN p_type WHEN p_partkey % 2 = 0 THEN 'info' END AS dir, p_brand AS country, concat_ws(',', CASE WHEN p_partkey % 3 > 0 AND p_partkey % 2 > 0 AND p_partkey % 5 > 0 THEN 'dir' END, 'country') AS gained FROM part")
def filled_details(spark, sf):
    p, k = _p(spark, sf)
    none = F.lit(None).cast("string").alias("country")
    pages = p.select(k.alias("id"), F.col("p_type").alias("dir"), F.col("p_brand").alias("country"))
    rec = p.filter(k % 3 == 0).select(k.alias("id"), F.lit("rec").alias("dir"), none)
    info = p.filter(k % 2 == 0).select(k.alias("id"), F.lit("info").alias("dir"), F.lit("").alias("country"))
    outer = p.filter(k % 5 == 0).select(k.alias("id"), F.lit("o").alias("dir"), none)
    return serving.fill_details(pages, rec, info, outer, ["dir", "country"])


@query("venue_facts", "SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE p_brand END AS director FROM part")
def venue_facts(spark, sf):
    p, k = _p(spark, sf)
    return serving.layered(p.select(k.alias("id")), [p.select(k.alias("id"), F.when(k % 2 == 0, F.col("p_type")).otherwise("").alias("director")), p.select(k.alias("id"), F.col("p_brand").alias("director"))], ["director"])


@query("confirmed_sales", "WITH d AS (SELECT o_orderkey AS slot, o_orderdate AS date, CASE WHEN o_orderkey % 3 = 0 THEN 'online' ELSE 'box office' END AS state FROM orders), a AS (SELECT slot FROM d WHERE state <> 'online' ORDER BY date, slot LIMIT 40) SELECT slot, CASE WHEN slot IN (SELECT slot FROM a) AND slot % 4 = 1 THEN 'online' ELSE state END AS state, slot IN (SELECT slot FROM a) AS asked FROM d")
def confirmed_sales(spark, sf):
    k = F.col("o_orderkey")
    d = table(spark, sf, "orders").select(k.alias("slot"), F.col("o_orderdate").alias("date"), F.when(k % 3 == 0, "online").otherwise("box office").alias("state"))
    return serving.confirm_sales(d, d.select("slot", (F.col("slot") % 4 == 1).alias("online")), 40)


@query("served_records", "SELECT p_partkey AS id, p_size / 10.0 AS imdb, CASE WHEN p_size >= 10 THEN (p_size // 10) || '.0K' ELSE (p_size * 100)::VARCHAR END AS votes, 1990 + p_partkey % 30 AS year, CASE WHEN p_partkey % 4 < 2 AND p_partkey % 3 > 0 THEN 'abcdefgh_-1' END AS trailer FROM (SELECT p_partkey, CASE WHEN p_size >= 10 THEN p_size // 10 * 10 ELSE p_size END AS p_size FROM part WHERE p_partkey % 5 > 0)")
def served_records(spark, sf):
    p, k = _p(spark, sf)
    s = F.when(F.col("p_size") >= 10, F.floor(F.col("p_size") / 10) * 10).otherwise(F.col("p_size"))
    y = k % 30 + 1990
    d = p.select(k.alias("id"), (k % 5 > 0).alias("matched"), F.when(k % 4 == 0, None).when(k % 4 == 1, y - 1).otherwise(y - 2).alias("year"), y.alias("outer_year"), (s / 10.0).alias("imdb"), (s * 100).alias("votes"), F.lit("abcdefgh_-1").alias("trailer_key"), F.when(k % 3 > 0, "en").otherwise("fr").alias("trailer_lang"), F.lit("Trailer").alias("trailer_kind"))
    return serving.served(d)


@query("probe_reports", "SELECT regexp_replace(lower(regexp_extract(url, '://([^/?#:]*)', 1)), '^www\\.', '') AS host, count(*) AS pages, sum(length(html))::BIGINT AS chars, count(*) FILTER (contains(html, '<p')) AS mark_0, count(*) FILTER (contains(html, 'href')) AS mark_1 FROM pages GROUP BY 1")
def probe_reports(spark, sf):
    return serving.probe_report(table(spark, sf, "pages"), ["<p", "href"])


@query("markdown_report", "SELECT * FROM (VALUES (0, '# Health'), (1, ''), (2, '| kind | covered | missing |'), (3, '|---|---|---|')) v(position, line) UNION ALL SELECT 3 + row_number() OVER (ORDER BY lang), '| ' || lang || ' | ' || c || '/' || n || ' | ' || (n - c) || ' |' FROM (SELECT lang, count(*) AS n, count(*) FILTER (n_chars > 300) AS c FROM documents WHERE lang IS NOT NULL GROUP BY 1)")
def markdown_report(spark, sf):
    d = table(spark, sf, "documents").filter("lang is not null").groupBy(F.col("lang").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") > 300).alias("covered"))
    return serving.markdown(d, "Health")


@query("programme_pages", "SELECT o_custkey AS page, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place, 'Play ' || o_orderkey AS title, (10 + o_orderkey % 10) || ':30' AS time, CASE WHEN o_orderkey % 3 > 0 THEN 'Hall ' || (o_orderkey % 3) END AS hall FROM orders")
def programme_pages(spark, sf):
    k = F.col("o_orderkey").cast("string")
    item = F.concat(F.lit("<li class=\"show\"><h3>Play "), k, F.lit("</h3><time>"), (F.col("o_orderkey") % 10 + 10).cast("string"), F.lit(":30</time>"), F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("<i>Hall "), (F.col("o_orderkey") % 3).cast("string"), F.lit("</i>"))).otherwise(""), F.lit("</li>"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("page"), F.struct("o_orderkey", item.alias("h")).alias("x"))
    pages = o.groupBy("page").agg(F.concat(F.lit("<ul>"), F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["h"]), "\n"), F.lit("</ul>")).alias("html"))
    return serving.page_rows(pages, "html", "(?s)<li class=\"show\">.*?</li>", {"title": "<h3>(.*?)</h3>", "time": r"<time>(\d{2}:\d{2})</time>", "hall": "<i>(.*?)</i>"}, ["page"])


@query("day_verdicts", "SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'unread' WHEN 1 THEN 'another day' WHEN 2 THEN CASE WHEN o_custkey % 3 = 0 THEN 'empty' ELSE 'ok' END ELSE CASE WHEN o_custkey % 3 = 0 THEN 'empty' ELSE 'ok' END END AS verdict FROM orders")
def day_verdicts(spark, sf):
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    html = F.when(k % 4 == 1, F.concat(F.lit("<h1>"), F.date_add(d, 1).cast("string"))).when(k % 4 == 2, F.concat(F.lit("<h1>"), d.cast("string"))).when(k % 4 == 3, F.concat(F.lit("<h1>"), F.date_format(d, "dd.MM.yyyy")))
    return serving.day_verdicts(table(spark, sf, "orders").select(k.alias("id"), d.alias("asked"), html.alias("html"), (F.col("o_custkey") % 3).alias("slots")))


@query("sale_badges", "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'cancelled' WHEN 1 THEN 'sold out' WHEN 2 THEN 'box office' WHEN 3 THEN 'not yet' WHEN 4 THEN 'online' ELSE 'unknown' END AS state, CASE WHEN o_custkey % 3 = 0 THEN 'own' WHEN o_custkey % 3 = 1 THEN 'city' ELSE 'touring' END AS part FROM orders")
def sale_badges(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    words = F.element_at(F.array(*map(F.lit, ("ОТМЕНЕНО, купи билет", "Разпродадено", "Билети само на каса", "Очаквайте", "Купи билет", "19:00"))), (k % 6 + 1).cast("int"))
    d = table(spark, sf, "orders").select("o_orderkey", serving.sale_state(words).alias("state"), F.when(c % 3 == 0, "").when(c % 3 == 1, "София, зала 1").otherwise("Пловдив").alias("place"))
    return serving.touring(d, "сцена", "софия").drop("place")


@query("decoded_pages", "SELECT p_partkey, 'Кино ' || p_name AS t FROM part")
def decoded_pages(spark, sf):
    p, k = _p(spark, sf)
    # the second as the Windows bytes of the same text
    d = p.select("p_partkey", F.when(k % 2 == 0, F.encode(F.concat(F.lit("Кино "), F.col("p_name")), "utf-8")).otherwise(F.unhex(F.concat(F.lit("CAE8EDEE20"), F.hex("p_name")))).alias("b"))
    return d.select("p_partkey", serving.decoded("b").alias("t"))


@query("table_sink", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def table_sink(spark, sf):
    rows = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return sources.write_table(rows, f"{graph.shared_folder(spark)}/plumbline-sink/{uuid.uuid4().hex}", ["o_custkey"])


@query("redirect_pages", "SELECT p_partkey AS old, p_partkey - p_partkey % 4 AS final, '/film/' || (p_partkey - p_partkey % 4) || '/' AS target FROM part WHERE p_partkey % 4 > 1 AND p_partkey - p_partkey % 4 IN (SELECT l_partkey FROM lineitem)")
def redirect_pages(spark, sf):
    p, k = _p(spark, sf)
    shown = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("final")).distinct()
    m = p.filter(k % 4 > 1).select(k.alias("old"), (k - k % 4).alias("final"))
    return m.join(shown, "final", "left_semi").select("old", "final", F.concat(F.lit("/film/"), F.col("final").cast("string"), F.lit("/")).alias("target"))


@query("synopsis_candidates", "SELECT d.doc_id AS id, page_id FROM documents d JOIN pages ON page_id = d.doc_id // 4 WHERE n_chars < 280 AND doc_id % 3 > 0 AND contains(url, 'example.')")
def synopsis_candidates(spark, sf):
    d = table(spark, sf, "documents").filter((F.col("n_chars") < 280) & (F.col("doc_id") % 3 > 0)).select(F.col("doc_id").alias("id"), F.expr("doc_id div 4").alias("page_id"))
    pages = table(spark, sf, "pages").filter(F.contains("url", F.lit("example."))).select("page_id")
    return d.join(pages, "page_id").select("id", "page_id")


@query("loaded_merges", "SELECT event_id AS \"drop\", json_extract_string(t, '$.into') AS into FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{\"into\": \"f' || user_id || '\", \"rule\": \"x\"}' WHEN 1 THEN '{\"rule\": \"x\"}' WHEN 2 THEN '[]' ELSE '{\"into\": \"g\"}' END AS t FROM events) WHERE event_id % 4 IN (0, 3)")
def loaded_merges(spark, sf):
    k = F.col("event_id")
    t = F.when(k % 4 == 0, F.concat(F.lit('{"into": "f'), F.col("user_id").cast("string"), F.lit('", "rule": "x"}'))).when(k % 4 == 1, '{"rule": "x"}').when(k % 4 == 2, "[]").otherwise('{"into": "g"}')
    d = sources.json_sidecar(table(spark, sf, "events").select(k.alias("drop"), t.alias("t")), "t", "into string, rule string")
    return d.select("drop", "value.into").filter("into is not null")


@query("parsed_reports", "SELECT event_id, user_id AS n, event_id % 50 AS covered FROM events WHERE event_id % 3 = 0")
def parsed_reports(spark, sf):
    k = F.col("event_id")
    out = F.concat(F.lit("checks...\nCOVERAGE broken\n"), F.when(k % 3 == 0, F.concat(F.lit("COVERAGE "), F.to_json(F.struct(F.col("user_id").alias("n"), (k % 50).alias("covered"))))).otherwise("done"), F.lit("\nend"))
    d = table(spark, sf, "events").select("event_id", F.regexp_extract(out, r"(?m)^COVERAGE (\{.*\})$", 1).alias("j"))
    return d.filter("j <> ''").select("event_id", F.from_json("j", "n long, covered long").alias("v")).select("event_id", "v.n", "v.covered")


@query("box_office_venues", "SELECT s_suppkey AS venue, s_suppkey % 5 = 0 AS in_person, s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 AS festival_sales FROM supplier WHERE s_suppkey % 5 = 0 OR s_suppkey % 7 = 0")
def box_office_venues(spark, sf):
    k = F.col("s_suppkey")
    b = table(spark, sf, "supplier").select(k.alias("venue"), F.to_json(F.struct((k % 5 == 0).alias("inPerson"), (k % 7 == 0).alias("festival"))).alias("booking"))
    v = sources.json_sidecar(b, "booking", "inPerson boolean, festival boolean").select("venue", F.col("value.inPerson").alias("in_person"), "value.festival")
    return v.filter("in_person or festival").select("venue", "in_person", (F.col("in_person") | F.col("festival")).alias("festival_sales"))


@query("identity_facts", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 1950 + p_size WHEN p_partkey % 3 = 0 THEN 1900 + p_size END AS year, p_size AS runtime FROM part")
def identity_facts(spark, sf):
    from plumbline.functions import text

    p, k = _p(spark, sf)
    s = F.col("p_size")
    alt = F.when(k % 3 == 0, F.concat("p_name", F.lit(" ("), (s + 1900).cast("string"), F.lit(")")))
    return p.select("p_partkey", F.coalesce(F.when(k % 2 == 0, s + 1950), text.title_year(alt)).alias("year"), s.alias("runtime"))


@query("paragraph_kinds", "SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'credit' WHEN 1 THEN 'visit' WHEN 2 THEN 'epigraph' WHEN 3 THEN 'person' WHEN 4 THEN 'prose' ELSE 'short' END AS kind FROM part")
def paragraph_kinds(spark, sf):
    p, k = _p(spark, sf)
    n = F.col("p_name")
    said = F.element_at(F.array(
        F.concat(F.lit("Режисьор: "), n), F.concat(F.lit("Билети от "), n), F.concat(F.lit("„Да бъде "), n, F.lit(" небето…“")), F.concat(F.lit("Роден в град "), n, F.lit(", живее там.")),
        F.concat(F.lit("една дълга история за "), n, F.lit(", която се разказва бавно и с много думи. накрая свършва.")), n,
    ), (k % 6 + 1).cast("int"))
    return p.select("p_partkey", html.paragraph_kind(said).alias("kind"))


@query("challenge_pages", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Cloudflare challenge' WHEN 1 THEN 'DDoS-Guard' WHEN 2 THEN NULL END AS name, CASE page_id % 5 WHEN 0 THEN 'rules' WHEN 1 THEN 'none' ELSE 'unreachable' END AS robots FROM pages")
def challenge_pages(spark, sf):
    k = F.col("page_id")
    page = F.concat(F.when(k % 4 == 0, "<TITLE>Just a moment...</TITLE>").when(k % 4 == 1, "<title>DDoS-Guard</title>").otherwise(""), "html")
    status = F.when(k % 5 == 0, 200).when(k % 5 == 1, 404).when(k % 5 == 2, 429).when(k % 5 == 3, 200)
    return table(spark, sf, "pages").select("page_id", control.challenge(page).alias("name"), control.robots_verdict(status, F.when(k % 5 == 3, "challenge")).alias("robots"))


@query("named_places", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'derida,g8' WHEN 1 THEN 'topl' WHEN 2 THEN '' ELSE 'g8' END AS places FROM part")
def named_places(spark, sf):
    p, k = _p(spark, sf)
    n = F.col("p_name")
    said = F.element_at(F.array(F.concat(n, F.lit(" на сцена „Дерида“, после в зала 1 на G8.")), F.concat(n, F.lit(" към РЦСИ Топлоцентрала")), F.concat(n, F.lit(" с партньори Дерида и G8")), F.concat(n, F.lit(" пред G8"))), (k % 4 + 1).cast("int"))
    places = listing.named_places(said, {"derida": ["сцена дерида"], "g8": ["g8"], "topl": ["рцси топлоцентрала", "топлоцентрала"]})
    return p.select("p_partkey", F.array_join(places, ",").alias("places"))


@query("multi_hall_titles", "WITH s AS (SELECT DISTINCT l_suppkey AS venue, date_trunc('month', l_shipdate) AS date, l_linenumber AS time, l_partkey AS id FROM lineitem), m AS (SELECT DISTINCT a.venue, a.date, a.time FROM s a JOIN s b ON a.venue = b.venue AND a.date = b.date AND a.time = b.time AND a.id < b.id JOIN part p ON p.p_partkey = a.id JOIN part q ON q.p_partkey = b.id WHERE NOT list_has_any(string_split(p.p_name, ' '), string_split(q.p_name, ' '))) SELECT venue FROM m GROUP BY 1 HAVING count(*) >= 2")
def multi_hall_titles(spark, sf):
    p, k = _p(spark, sf)
    slots = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("venue"), F.trunc("l_shipdate", "month").alias("date"), F.col("l_linenumber").alias("time"))
    return duplicates.multi_hall_venues(p.select(k.alias("id"), F.col("p_name").alias("key")), slots)


@query("top_cast", "SELECT p_type, array_to_string(list(p_name ORDER BY f)[1:5], ', ') AS names FROM (SELECT p_type, p_name, min(p_partkey) AS f FROM part GROUP BY 1, 2) GROUP BY 1")
def top_cast(spark, sf):
    return events.first_names(table(spark, sf, "part"), "p_type", "p_partkey", "p_name", 5)


@query("record_contradictions", "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 AND p_partkey % 2 > 0 THEN 'year' WHEN p_size % 7 = 0 THEN 'runtime' WHEN p_partkey % 3 = 0 THEN 'director' END AS fact FROM part")
def record_contradictions(spark, sf):
    p, k = _p(spark, sf)
    a, b = F.lit("Ферзан Йозпетек"), F.when(k % 3 == 0, "Jimmy Chin").when(k % 3 == 1, "Ferzan Ozpetek").otherwise("")
    d = p.select("p_partkey", "p_size", F.lit(2000).alias("ya"), F.when(k % 5 == 0, 2010).otherwise(2004).alias("yb"), a.alias("da"), b.alias("db")).withColumn("agree", identity.names_agree("da", "db"))
    runtime = F.abs(F.when(F.col("p_size") % 7 == 0, 60).otherwise(0)) <= 25
    year = identity.plausible_year(F.col("yb"), F.col("ya"), F.col("p_partkey") % 2 == 0)
    return d.select("p_partkey", events.contradiction([("year", year), ("runtime", runtime), ("director", F.col("agree"))]).alias("fact"))
