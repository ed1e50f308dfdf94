"""Links, attributes, pictures and aliases."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import links
from plumbline.registry import query
from plumbline.session import table


def _text(d):
    return d.withColumns({c: F.col(c).cast("string") for c, t in d.dtypes if t == "date"})


_P = "p AS (SELECT l_orderkey * 8 + l_linenumber AS \"show\", l_shipdate::DATE AS date, (10 + l_linenumber) || ':00' AS time, l_suppkey AS s, l_partkey AS k FROM lineitem)"
_URL = "'https://t.bg/' || CASE WHEN k % 5 = 0 THEN 'e/' || (\"show\" // 16) WHEN k % 5 = 1 THEN 'd/' || (date + CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END)::VARCHAR || '|' || time || ':00/' || \"show\" ELSE 'u/' || \"show\" END"


def _performances(spark, sf):
    l = table(spark, sf, "lineitem")
    return l.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("show"), F.col("l_shipdate").cast("date").alias("date"), F.concat((F.col("l_linenumber") + 10).cast("string"), F.lit(":00")).alias("time"), F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("k"))


def _url(prefix="https://t.bg/"):
    k, show = F.col("k"), F.col("show")
    dated = F.concat(F.lit("d/"), F.date_add("date", F.when(k % 2 == 0, 1).otherwise(0)).cast("string"), F.lit("|"), "time", F.lit(":00/"), show.cast("string"))
    return F.concat(F.lit(prefix), F.when(k % 5 == 0, F.concat(F.lit("e/"), F.expr("cast(show div 16 as string)"))).when(k % 5 == 1, dated).otherwise(F.concat(F.lit("u/"), show.cast("string"))))


@query("performance_links", f"""WITH {_P}, own AS (SELECT DISTINCT "show", date, time, {_URL} AS url, 0 AS rank FROM p WHERE s % 3 = 0), oth AS (SELECT DISTINCT "show", date, time, 'https://a.bg/' || "show" AS url, 1 AS rank FROM p WHERE s % 3 < 2), box AS (SELECT "show", date, time FROM p WHERE k % 11 = 0),
prv AS (SELECT DISTINCT "show", date, time, 'https://o.bg/' || ("show" // 3) AS url FROM p WHERE s % 2 = 0), rd AS (SELECT "show", date, time FROM p WHERE s % 3 = 0 OR s % 5 = 0), live AS (SELECT DISTINCT "show", date, time FROM p WHERE ("show", date, time) NOT IN (SELECT ("show", date, time) FROM box)),
g AS (SELECT * FROM own UNION SELECT * FROM oth), us AS (SELECT url, count(*) AS n FROM (SELECT DISTINCT "show", date, time, url FROM g) GROUP BY 1), b AS (SELECT "show", date, time, count(*) AS n, min(url) AS url FROM g WHERE ("show", date, time, rank) IN (SELECT ("show", date, time, min(rank)) FROM g GROUP BY "show", date, time) GROUP BY ALL),
fr AS (SELECT l."show", l.date, l.time, b.url FROM live l JOIN b USING ("show", date, time) JOIN us USING (url) WHERE b.n = 1 AND us.n = 1 AND (regexp_extract(b.url, '\\d{{4}}-\\d{{2}}-\\d{{2}}') IN ('', l.date::VARCHAR))),
old AS (SELECT "show", date, time, url, row_number() OVER (PARTITION BY url ORDER BY "show", date, time) AS i FROM prv WHERE ("show", date, time) IN (SELECT ("show", date, time) FROM live) AND ("show", date, time) NOT IN (SELECT ("show", date, time) FROM fr) AND ("show", date, time) NOT IN (SELECT ("show", date, time) FROM rd))
SELECT "show", date::VARCHAR AS date, time, url FROM fr UNION ALL SELECT "show", date::VARCHAR, time, url FROM old WHERE i = 1""")
def performance_links(spark, sf):
    p, s, k = _performances(spark, sf), F.col("s"), F.col("k")
    show = F.col("show").cast("string")
    return _text(links.performance_links(
        p, p.filter(s % 3 == 0).withColumn("url", _url()), p.filter(s % 3 < 2).withColumn("url", F.concat(F.lit("https://a.bg/"), show)), p.filter(s % 2 == 0).withColumn("url", F.concat(F.lit("https://o.bg/"), F.expr("cast(show div 3 as string)"))).select("show", "date", "time", "url").distinct(),
        p.filter(k % 11 == 0), p.filter((s % 3 == 0) | (s % 5 == 0))))


_L = "x AS (SELECT l_suppkey % 6 AS venue, l_partkey AS \"show\", l_shipdate::DATE AS date, l_linenumber AS time, l_orderkey AS o FROM lineitem)"


@query("link_choices", f"""WITH {_L}, st AS (SELECT * FROM (VALUES (0, 'official'), (1, 'official'), (2, 'none'), (3, 'unreachable'), (4, 'none'), (5, 'official')) s(venue, status)), live AS (SELECT DISTINCT "show" FROM x WHERE "show" % 7 < 6), e AS (SELECT DISTINCT "show", 'old/' || "show" AS url FROM x WHERE "show" % 5 = 0),
o AS (SELECT x.*, CASE WHEN o % 4 > 0 AND "show" % 3 > 0 THEN 'own/' || o END AS page FROM x JOIN st USING (venue) WHERE status = 'official' AND o % 3 = 0 AND "show" IN (SELECT "show" FROM live)),
w AS (SELECT "show", (list(page ORDER BY date, time, page) FILTER (page IS NOT NULL))[1] AS url FROM o WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' GROUP BY 1),
a AS (SELECT "show", (list('agg/' || o ORDER BY date, time, 'agg/' || o))[1] AS url FROM x JOIN st USING (venue) WHERE status <> 'unreachable' AND o % 3 = 1 AND o % 2 = 0 AND "show" IN (SELECT "show" FROM live) AND "show" NOT IN (SELECT "show" FROM o) AND "show" NOT IN (SELECT "show" FROM e) GROUP BY 1)
SELECT w."show", coalesce(w.url, e.url) AS url, CASE WHEN w.url IS NOT NULL THEN 'official' WHEN e.url IS NOT NULL THEN 'existing' ELSE 'none' END AS source FROM w LEFT JOIN e USING ("show") UNION ALL SELECT "show", url, 'secondary' FROM a UNION ALL SELECT "show", url, 'existing' FROM e WHERE "show" NOT IN (SELECT "show" FROM w)""")
def link_choices(spark, sf):
    x = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 6).alias("venue"), F.col("l_partkey").alias("show"), F.col("l_shipdate").cast("date").alias("date"), F.col("l_linenumber").alias("time"), F.col("l_orderkey").alias("o"))
    o, show = F.col("o"), F.col("show")
    status = spark.createDataFrame([(0, "official"), (1, "official"), (2, "none"), (3, "unreachable"), (4, "none"), (5, "official")], "venue long, status string")
    own = x.filter(o % 3 == 0).withColumn("page", F.when((o % 4 > 0) & (show % 3 > 0), F.concat(F.lit("own/"), o.cast("string"))))
    agg = x.filter(o % 3 == 1).withColumn("page", F.when(o % 2 == 0, F.concat(F.lit("agg/"), o.cast("string"))))
    e = x.filter(show % 5 == 0).select("show", F.concat(F.lit("old/"), show.cast("string")).alias("url")).distinct()
    return links.link_choice(own, agg, e, x.filter(show % 7 < 6), status, "1998-01-01", "1998-12-31")


@query("neutral_links", "SELECT p_partkey AS show, CASE WHEN p_partkey % 4 = 1 THEN 'https://t.bg/play/' || p_partkey WHEN p_size % 3 = 0 THEN 'https://t.bg/programme/' || (p_size % 3) END AS url FROM part WHERE p_partkey % 4 < 3")
def neutral_links(spark, sf):
    k = F.col("p_partkey")
    url = F.when(k % 4 == 1, F.concat(F.lit("https://t.bg/play/"), k.cast("string"), F.lit("/1998-06-01|19:00:00"))).when(k % 4 == 2, F.concat(F.lit("https://tickets.bg/"), k.cast("string"))).when(k % 4 == 3, F.lit("https://t.bg/fine"))
    d = table(spark, sf, "part").select(k.alias("show"), (F.col("p_size") % 3).cast("long").alias("venue"), url.alias("url"))
    home = spark.createDataFrame([(0, "https://t.bg/programme/0")], "venue long, home string")
    return links.neutral_links(d, home, r"\d{4}-\d{2}-\d{2}\|\d|//tickets\.bg/\d", (r"^(https://t\.bg/[^?#]*?)/\d{4}-\d{2}-\d{2}\|[\d:]+$", "$1"))


@query("ticket_links", """WITH s AS (SELECT l_partkey AS film, l_suppkey % 4 AS venue, l_shipdate::DATE AS date, CASE WHEN l_orderkey % 5 > 0 THEN 'https://shop.bg/' || l_orderkey ELSE 'https://evil.bg/' || l_orderkey END AS ticket, CASE WHEN l_partkey % 3 > 0 THEN 'https://www.fest.bg/f/' || l_partkey END AS page, l_linenumber AS time FROM lineitem WHERE l_shipdate >= '1998-06-01' AND l_shipdate < '1998-09-01'),
c AS (SELECT film, venue, count(DISTINCT (date, time)) AS n FROM s GROUP BY ALL), b AS (SELECT film, venue, count(DISTINCT ticket) FILTER (ticket LIKE 'https://shop%') AS k, min(ticket) FILTER (ticket LIKE 'https://shop%') AS ticket, min(page) AS page FROM s GROUP BY ALL)
SELECT film, venue, url FROM (SELECT b.film, b.venue, CASE WHEN n = 1 AND k = 1 THEN ticket ELSE page END AS url FROM b JOIN c USING (film, venue) WHERE film % 9 > 0) WHERE url IS NOT NULL""")
def ticket_links(spark, sf):
    l = table(spark, sf, "lineitem").filter((F.col("l_shipdate") >= F.lit("1998-06-01").cast("timestamp_ntz")) & (F.col("l_shipdate") < F.lit("1998-09-01").cast("timestamp_ntz")))
    k, o = F.col("l_partkey"), F.col("l_orderkey")
    s = l.select(k.alias("film"), (F.col("l_suppkey") % 4).alias("venue"), F.col("l_shipdate").cast("date").alias("date"), F.concat(F.when(o % 5 > 0, "https://shop.bg/").otherwise("https://evil.bg/"), o.cast("string")).alias("ticket"), F.when(k % 3 > 0, F.concat(F.lit("https://www.fest.bg/f/"), k.cast("string"))).alias("page"), F.col("l_linenumber").alias("time"))
    return links.ticket_links(s, s.filter("film % 9 = 0").select("film", "venue"), s, ["shop.bg", "fest.bg"])


@query("sale_states", "SELECT o_orderkey AS film, coalesce(CASE WHEN o_custkey % 3 = 0 THEN 'soldout' END, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 5 > 0 THEN CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'onsale' END END) AS state FROM orders")
def sale_states(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, sf, "orders").select(k.alias("film"), (c % 9).alias("venue"), F.col("o_orderdate").cast("date").alias("date"), F.lit("19:00").alias("time"), F.concat(F.lit("u"), k.cast("string")).alias("url"), c.alias("c"))
    states = rows.filter("c % 3 = 0").select("url", F.lit("soldout").alias("state"))
    prev = rows.filter("film % 4 = 0").select("film", "venue", "date", "time", F.when(F.col("film") % 5 > 0, F.col("url")).otherwise("other").alias("url"), F.when(F.col("film") % 7 == 0, "gone").otherwise("onsale").alias("state"))
    return links.sale_states(rows.drop("c"), states, prev, ["onsale", "soldout", "notyet"]).select("film", "state")


_A = "(SELECT DISTINCT l_partkey AS film, l_suppkey % 10 AS venue, l_shipdate::DATE::VARCHAR || ' ' || l_linenumber AS moment FROM lineitem WHERE l_orderkey % {} = 0)"


@query("attribute_overlay", f"WITH f AS (SELECT *, 'new' AS value FROM {_A.format(3)} WHERE film % 2 = 0), o AS (SELECT *, 'old' AS value FROM {_A.format(2)}), r AS (SELECT * FROM f UNION ALL SELECT * FROM o WHERE (film, venue) NOT IN (SELECT (film, venue) FROM f)) SELECT * FROM r WHERE (film, venue, moment) IN (SELECT (film, venue, moment) FROM {_A.format(4)})")
def attribute_overlay(spark, sf):
    def some(n):
        return table(spark, sf, "lineitem").filter(F.col("l_orderkey") % n == 0).select(F.col("l_partkey").alias("film"), (F.col("l_suppkey") % 10).alias("venue"), F.concat_ws(" ", F.col("l_shipdate").cast("date").cast("string"), F.col("l_linenumber").cast("string")).alias("moment")).distinct()

    return links.overlay_attributes(some(2).withColumn("value", F.lit("old")), some(3).filter("film % 2 = 0").withColumn("value", F.lit("new")), some(4))


@query("pruned_maps", "SELECT l_orderkey AS id, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def pruned_maps(spark, sf):
    m = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber")
    return links.prune(m, table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")))


_HOST = "regexp_replace(lower(regexp_extract(url, '://([^/?#:]*)', 1)), '^www\\.', '')"


@query("allowed_links", f"SELECT page_id FROM pages WHERE ({_HOST} = 'example.com' OR {_HOST} LIKE '%.example.com' OR (page_id % 2 = 0 AND ({_HOST} = 'example.org' OR {_HOST} LIKE '%.example.org'))) AND NOT ({_HOST} = 'm.example.com' OR {_HOST} LIKE '%.m.example.com')")
def allowed_links(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url", (F.col("page_id") % 2).alias("venue"))
    allow = spark.createDataFrame([(0, "example.com"), (1, "example.com"), (0, "example.org")], "venue long, host string")
    return links.allowed_links(p, allow, ["m.example.com"]).select("page_id")


@query("mirror_aliases", """WITH f AS (SELECT 'f' || p_partkey AS id, p_name || ' ' || p_brand || ' ' || p_size AS t FROM part WHERE p_partkey % 3 = 0), e AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 6 = 1 THEN 'f' || (p_partkey - 1) || '-gala' ELSE 'e' || p_partkey END AS id, CASE WHEN p_partkey % 6 = 4 THEN p_name || ' ' || p_brand || ' ' || p_size ELSE 'own ' || p_partkey END AS t FROM part WHERE p_partkey % 3 = 1 AND p_partkey % 5 > 0),
a AS (SELECT e.id AS event, min(f.id) AS film FROM e JOIN f USING (t) GROUP BY 1) SELECT * FROM a UNION ALL SELECT e.id, 'f' || (k - 1) FROM e WHERE k % 6 = 1 AND id NOT IN (SELECT event FROM a)""")
def mirror_aliases(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    t = F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string"))
    f = p.filter(k % 3 == 0).select(F.concat(F.lit("f"), k.cast("string")).alias("id"), F.array(t).alias("keys"))
    e = p.filter(k % 3 == 1).select(F.when(k % 6 == 1, F.concat(F.lit("f"), (k - 1).cast("string"), F.lit("-gala"))).otherwise(F.concat(F.lit("e"), k.cast("string"))).alias("id"), F.when(k % 5 > 0, "cinema").otherwise("theatre").alias("scope"), F.array(F.when(k % 6 == 4, t).otherwise(F.concat(F.lit("own "), k.cast("string")))).alias("keys"))
    return links.aliases(e, f, ["-gala", "-premiere"])


@query("shown_pictures", "SELECT p_partkey AS id, CASE WHEN b % 4 = 0 THEN 'https://a.bg/' || b || '.jpg' WHEN b % 3 = 0 THEN 'posters/p' || b || '.png' WHEN b % 5 = 1 THEN 'https://c.bg/' || b END AS picture, CASE WHEN b % 4 = 0 THEN 'art' WHEN b % 3 = 0 THEN 'posters' WHEN b % 5 = 1 THEN 'shows' END AS source FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN p_partkey + 1 ELSE p_partkey END AS b FROM part)")
def shown_pictures(spark, sf):
    ids = table(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    k, s = F.col("id"), F.col("id").cast("string")
    every = ids.unionByName(ids.select((k + 1).alias("id"))).distinct()
    moved = ids.filter(k % 7 == 0).select(k.alias("old"), (k + 1).alias("final"))
    art = every.filter(k % 2 == 0).select("id", F.when(k % 4 == 0, F.concat(F.lit("https://a.bg/"), s, F.lit(".jpg"))).otherwise("javascript:x").alias("url"))
    return links.shown_picture(ids, moved, [("art", art), ("posters", every.filter(k % 3 == 0).select("id", F.concat(F.lit("posters/p"), s, F.lit(".png")).alias("url"))), ("shows", every.filter(k % 5 == 1).select("id", F.concat(F.lit("https://c.bg/"), s).alias("url")))])


@query("event_art", "SELECT event, url FROM (SELECT *, row_number() OVER (PARTITION BY event ORDER BY w / h < 1.2, rank, url) AS i FROM (SELECT l_orderkey AS event, l_linenumber AS rank, 'u' || l_partkey AS url, l_quantity AS w, l_suppkey % 40 AS h, l_returnflag FROM lineitem) WHERE l_returnflag <> 'R' AND h > 0) WHERE i = 1")
def event_art(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("event"), F.col("l_linenumber").alias("rank"), F.concat(F.lit("u"), F.col("l_partkey").cast("string")).alias("url"), F.col("l_quantity").alias("w"), (F.col("l_suppkey") % 40).alias("h"), F.when(F.col("l_returnflag") == "R", "too small").alias("problem"))
    return links.key_art(d)


@query("shared_logos", "SELECT digest, n, array_to_string(ids[1:5], ',') AS ids FROM (SELECT md5(text) AS digest, count(DISTINCT doc_id) AS n, list_sort(list(DISTINCT doc_id)) AS ids FROM documents GROUP BY 1) WHERE n >= 2")
def shared_logos(spark, sf):
    return links.shared_logos(table(spark, sf, "documents").select(F.md5(F.col("text").cast("binary")).alias("digest"), F.col("doc_id").alias("id")))


@query("deep_links_dropped", "SELECT l_partkey AS film, l_suppkey AS venue, min(l_orderkey) AS url FROM lineitem WHERE l_suppkey % 8 <> 3 GROUP BY 1, 2")
def deep_links_dropped(spark, sf):
    v = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("film"), F.col("l_suppkey").alias("venue")).agg(F.min("l_orderkey").alias("url"))
    deep = table(spark, sf, "supplier").filter("s_suppkey % 8 = 3").select(F.col("s_suppkey").alias("venue"))
    return v.join(deep, "venue", "left_anti").select("film", "venue", "url")
