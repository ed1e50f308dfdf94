"""Identity, text, page and stream queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import sources, streaming
from plumbline.functions import html, text, urls
from plumbline.operators import graph, identity
from plumbline.registry import query
from plumbline.session import table

_FOLD = "trim(regexp_replace(regexp_replace(regexp_replace(replace(translate(lower({0}), 'ёѝ', 'еи'), '&', CASE WHEN regexp_matches(lower({0}), '\\p{{Cyrillic}}') THEN ' и ' ELSE ' and ' END), '[''’`ʼ]', '', 'g'), '[^\\p{{L}}\\p{{N}}\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
_YEAR = r"'\s*(?:[(\[]\s*((?:18|19|20)\d{2})\s*[)\]]|\|\s*((?:18|19|20)\d{2})\s*\|?)\s*$'"
_CLEAN = "trim(trim(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace({0}, '\\s+', ' ', 'g')), '(?i)\\b(?:imax\\s+3d|imax|4dx|3d|2d|dubbed|subtitled|dolby\\s+atmos)\\b', ' ', 'g'), '[\\(\\[][\\s,;/–—+-]*[\\)\\]]', ' ', 'g'), '\\s+', ' ', 'g')), ' -–—:,|')"
_CORE = f"trim(regexp_replace({{0}}, {_YEAR.replace('{2}', '{{2}}')}, ''))"


def _key(x: str) -> str:
    return _FOLD.format(_CORE.format(_CLEAN.format(x)))


def _base(x: str) -> str:
    first = f"regexp_extract({_CORE.format(_CLEAN.format(x))}, '^(.*?)\\s*(?::|\\s[–—-]\\s)\\s*\\S', 1)"
    return f"CASE WHEN trim({first}) <> '' AND {_FOLD.format(first)} <> '' AND {_FOLD.format(first)} <> {_key(x)} THEN {_FOLD.format(first)} END"


_NOISY = "CASE p_partkey % 6 WHEN 0 THEN upper(p_name) || ' (IMAX)' WHEN 1 THEN p_name || ': ' || p_brand WHEN 2 THEN '«' || p_name || '» 3D – ' || p_type WHEN 3 THEN p_name || ' & ' || p_type || ' (' || (1950 + p_size)::VARCHAR || ')' WHEN 4 THEN ' ' || p_name || '''s  dubbed' ELSE p_name || ' | ' || (1990 + p_size % 30)::VARCHAR || ' |' END"


def _noisy():
    n, name = F.col("p_partkey") % 6, F.col("p_name")
    return (
        F.when(n == 0, F.concat(F.upper(name), F.lit(" (IMAX)"))).when(n == 1, F.concat(name, F.lit(": "), "p_brand")).when(n == 2, F.concat(F.lit("«"), name, F.lit("» 3D – "), "p_type"))
        .when(n == 3, F.concat(name, F.lit(" & "), "p_type", F.lit(" ("), (F.col("p_size") + 1950).cast("string"), F.lit(")"))).when(n == 4, F.concat(F.lit(" "), name, F.lit("'s  dubbed")))
        .otherwise(F.concat(name, F.lit(" | "), (F.col("p_size") % 30 + 1990).cast("string"), F.lit(" |")))
    )


@query("title_keys", f"WITH t AS (SELECT p_partkey, {_NOISY} AS t FROM part) SELECT p_partkey, {_key('t')} AS key, {_base('t')} AS base, TRY_CAST(regexp_extract({_CLEAN.format('t')}, {_YEAR}, 1) || regexp_extract({_CLEAN.format('t')}, {_YEAR}, 2) AS INTEGER) AS year FROM t")
def title_keys(spark, sf):
    t = F.col("t")
    return table(spark, sf, "part").select("p_partkey", _noisy().alias("t")).select("p_partkey", text.key(t).alias("key"), text.base_key(t).alias("base"), text.title_year(text.clean_title(t)).alias("year"))


@query("document_keys", f"SELECT doc_id, md5({_FOLD.format('text')}) AS key FROM documents")
def document_keys(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.fold(F.col("text")).cast("binary")).alias("key"))


_SINGLE = [k for k, v in text.LETTERS.items() if len(v) == 1]
_TRANSLIT = "translate({0}, '" + "".join(_SINGLE) + "', '" + "".join(text.LETTERS[k] for k in _SINGLE) + "')"
for _k, _v in text.LETTERS.items():
    if len(_v) > 1:
        _TRANSLIT = f"replace({_TRANSLIT}, '{_k}', '{_v}')"
_CYR = "translate({0}, 'abcdeghijklmnoprstuwxyz', 'абцдегхийклмнопрстужщюя')"


@query("translit_key", f"SELECT p_partkey, {_TRANSLIT.format(_CYR.format('p_name'))} AS key, trim(regexp_replace({_TRANSLIT.format(_CYR.format('lower(p_name)'))}, '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def translit_key(spark, sf):
    c = F.translate(F.col("p_name"), "abcdeghijklmnoprstuwxyz", "абцдегхийклмнопрстужщюя")
    return table(spark, sf, "part").select("p_partkey", text.translit(c).alias("key"), text.slug(c).alias("slug"))


_CAT = "SELECT p_partkey AS id, p_name || ' ' || p_size::VARCHAR AS title, CASE WHEN p_partkey % 11 > 0 THEN 1990 + p_partkey % 30 END AS year, p_partkey % 4 = 0 AS minted FROM part WHERE p_partkey % 3 = 0"
_TIT = "SELECT p_partkey AS title_id, CASE p_partkey % 4 WHEN 0 THEN upper(p_name || ' ' || p_size::VARCHAR) WHEN 1 THEN p_name || ' ' || p_size::VARCHAR || ': ' || p_brand WHEN 2 THEN substr(p_name, 1, 2) || substr(p_name, 4) || ' ' || p_size::VARCHAR ELSE '\"' || p_name || '\" ' || p_size::VARCHAR END AS title, CASE WHEN p_partkey % 5 > 0 THEN 1990 + p_partkey % 30 END AS year FROM part WHERE p_partkey % 3 = 1"
_WORDS = "len(string_split({0}, ' '))"
_DIGITS = "array_to_string(regexp_extract_all({0}, '[0-9]+'), ' ')"
_FOUND = f"""WITH c0 AS ({_CAT}), t0 AS ({_TIT}), c AS (SELECT *, {_key('title')} AS key, {_base('title')} AS base FROM c0), t AS (SELECT *, {_key('title')} AS key, {_base('title')} AS base FROM t0),
r AS (SELECT title_id, id, 1 AS rule FROM t JOIN c ON t.key = c.key UNION SELECT title_id, id, 2 FROM t JOIN c ON t.base = c.key OR t.key = c.base
UNION SELECT title_id, id, 3 FROM t JOIN c ON levenshtein(t.key, c.key) = 1 AND {_WORDS.format('t.key')} = {_WORDS.format('c.key')} AND {_DIGITS.format('t.key')} = {_DIGITS.format('c.key')} AND length(regexp_replace(t.key, '\\P{{L}}', '', 'g')) >= 8 AND length(regexp_replace(c.key, '\\P{{L}}', '', 'g')) >= 8),
f AS (SELECT r.*, t.year AS ty, c.year AS cy, minted FROM r JOIN t USING (title_id) JOIN c USING (id) WHERE NOT coalesce(abs(t.year - c.year) > 1, false))
"""
_CHOSEN = _FOUND + """, g AS (SELECT title_id, rule, count(*) AS n, min(id) AS lone, count(*) FILTER (NOT minted) AS seeds, min(id) FILTER (NOT minted) AS seed, count(*) FILTER (NOT minted AND ty = cy) AS sy, min(id) FILTER (NOT minted AND ty = cy) AS sid, count(*) FILTER (ty = cy) AS ys, min(id) FILTER (ty = cy) AS yid
FROM f WHERE (title_id, rule) IN (SELECT (title_id, min(rule)) FROM f GROUP BY title_id) GROUP BY 1, 2),
x AS (SELECT title_id, rule, CASE WHEN n = 1 THEN lone WHEN seeds = 1 THEN seed WHEN (CASE WHEN seeds > 0 THEN sy ELSE ys END) = 1 THEN CASE WHEN seeds > 0 THEN sid ELSE yid END END AS id, CASE WHEN n = 1 THEN 'single' WHEN seeds = 1 THEN 'catalogue' WHEN (CASE WHEN seeds > 0 THEN sy ELSE ys END) = 1 THEN 'year' ELSE 'ambiguous' END AS why FROM g)
"""


def _titles(spark, sf):
    p, k, size = table(spark, sf, "part"), F.col("p_partkey"), F.col("p_size").cast("string")
    year = (k % 30 + 1990).cast("int")
    full = F.concat_ws(" ", "p_name", size)
    cat = p.filter(k % 3 == 0).select(k.alias("id"), full.alias("title"), F.when(k % 11 > 0, year).alias("year"), (k % 4 == 0).alias("minted"))
    noisy = F.when(k % 4 == 0, F.upper(full)).when(k % 4 == 1, F.concat(full, F.lit(": "), "p_brand")).when(k % 4 == 2, F.concat(F.substring("p_name", 1, 2), F.expr("substr(p_name, 4)"), F.lit(" "), size)).otherwise(F.concat(F.lit('"'), "p_name", F.lit('" '), size))
    return p.filter(k % 3 == 1).select(k.alias("title_id"), noisy.alias("title"), F.when(k % 5 > 0, year).alias("year")), cat


@query("resolve_candidates", _FOUND + "SELECT title_id, id, rule FROM f")
def resolve_candidates(spark, sf):
    return identity.candidates(*_titles(spark, sf)).select("title_id", "id", "rule")


@query("resolve_exact", _FOUND + "SELECT title_id, id FROM f WHERE rule = 1")
def resolve_exact(spark, sf):
    return identity.candidates(*_titles(spark, sf)).filter("rule = 1").select("title_id", "id")


@query("resolve_spelling", _FOUND + "SELECT title_id, id FROM f WHERE rule = 3")
def resolve_spelling(spark, sf):
    return identity.candidates(*_titles(spark, sf)).filter("rule = 3").select("title_id", "id")


@query("resolve_cascade", _CHOSEN + "SELECT * FROM x")
def resolve_cascade(spark, sf):
    return identity.choose(identity.candidates(*_titles(spark, sf)))


@query("resolve_ambiguous", _CHOSEN + "SELECT rule, why, count(*) AS n FROM x GROUP BY 1, 2")
def resolve_ambiguous(spark, sf):
    return identity.choose(identity.candidates(*_titles(spark, sf))).groupBy("rule", "why").agg(F.count(F.lit(1)).alias("n"))


@query("suspect_pairs", "WITH k AS (SELECT DISTINCT p_size, p_name AS key FROM part) SELECT a.p_size, a.key AS a, b.key AS b, levenshtein(a.key, b.key) AS distance FROM k a JOIN k b ON a.p_size = b.p_size AND a.key < b.key WHERE levenshtein(a.key, b.key) <= 2")
def suspect_pairs(spark, sf):
    return identity.suspects(table(spark, sf, "part").select("p_size", F.col("p_name").alias("key")), "p_size")


_REC = "SELECT p_partkey AS id, p_name AS key, 1990 + p_size % 25 AS year FROM part"


def _records(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("key"), (F.col("p_size") % 25 + 1990).alias("year"))


_EDGES = f"WITH RECURSIVE r AS ({_REC}), y AS (SELECT key, year, min(id) AS first FROM r GROUP BY 1, 2), e AS (SELECT first AS a, id AS b FROM r JOIN y USING (key, year) WHERE id <> first UNION ALL SELECT y1.first, y2.first FROM y y1 JOIN y y2 ON y1.key = y2.key AND y2.year = y1.year + 1)"


@query("dup_edges", _EDGES + " SELECT a, b FROM e")
def dup_edges(spark, sf):
    return identity.duplicate_edges(_records(spark, sf))


_GRAPH = "SELECT DISTINCT o_orderkey AS a, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey - o_orderkey % 5 ELSE o_custkey * 100000 END AS b FROM orders"


@query("dup_components", f"""WITH RECURSIVE e AS (SELECT a, b FROM ({_GRAPH}) WHERE a <> b), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), n AS (SELECT DISTINCT a AS node FROM s), r AS (SELECT node, node AS reach FROM n UNION SELECT r.node, s.b FROM r JOIN s ON s.a = r.reach) SELECT node, min(reach) AS root FROM r GROUP BY 1""")
def dup_components(spark, sf):
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(k.alias("a"), F.when(k % 5 > 0, k - k % 5).otherwise(F.col("o_custkey") * 100_000).alias("b"))
    return graph.components(o)


@query("redirect_closure", """WITH RECURSIVE m AS (SELECT o_orderkey AS old, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey // 3 ELSE -o_orderkey END AS target FROM orders WHERE o_orderkey > 2), r AS (SELECT old, target FROM m UNION ALL SELECT r.old, m.target FROM r JOIN m ON m.old = r.target) SELECT old, target AS final FROM r WHERE target NOT IN (SELECT old FROM m)""")
def redirect_closure(spark, sf):
    k = F.col("o_orderkey")
    m = table(spark, sf, "orders").filter(k > 2).select(k.alias("old"), F.when(k % 5 > 0, F.expr("o_orderkey div 3")).otherwise(-k).alias("into"))
    return graph.redirects(m)


@query("survivor_rank", "SELECT id, into_id AS into, comp FROM (SELECT p_partkey AS id, p_name AS comp, first_value(p_partkey) OVER (PARTITION BY p_name ORDER BY p_partkey % 4 = 0, p_brand LIKE '%2%', -p_size, -length(p_type), -p_retailprice, p_type, p_partkey) AS into_id FROM part) WHERE id <> into_id")
def survivor_rank(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("comp"), "p_brand", "p_size", "p_type", "p_retailprice")
    order = [F.col("id") % 4 == 0, F.col("p_brand").contains("2"), -F.col("p_size"), -F.length("p_type"), -F.col("p_retailprice"), F.col("p_type"), F.col("id")]
    return identity.survivors(p, "comp", order).select("id", "into", "comp")


@query("candidate_score", """WITH q AS (SELECT p_partkey AS qid, p_name AS q, 1990 + p_partkey % 30 AS wanted, p_size FROM part WHERE p_partkey % 50 = 0), c AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_name || ' ' || p_type END AS t, CASE WHEN p_partkey % 9 > 0 THEN 1990 + p_partkey % 28 END AS year, CAST(p_retailprice * 4 AS BIGINT) AS votes, p_size FROM part),
s AS (SELECT qid, id, CASE WHEN t = q THEN 100 WHEN contains(t, q) OR contains(q, t) THEN 40 ELSE 0 END + coalesce(CASE WHEN year = wanted THEN 50 WHEN abs(year - wanted) <= 1 THEN 20 ELSE -10 * least(abs(year - wanted), 5) END, 0) + least(votes, 5000) / 5000.0 AS score FROM q JOIN c USING (p_size))
SELECT qid, id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS n FROM s) WHERE n = 1""")
def candidate_score(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    q = p.filter(k % 50 == 0).select(k.alias("qid"), F.col("p_name").alias("q"), (k % 30 + 1990).alias("wanted"), "p_size")
    c = p.select(k.alias("id"), F.when(k % 2 == 0, F.col("p_name")).otherwise(F.concat_ws(" ", "p_name", "p_type")).alias("t"), F.when(k % 9 > 0, k % 28 + 1990).alias("year"), F.round(F.col("p_retailprice") * 4).cast("long").alias("votes"), "p_size")
    s = q.join(c, "p_size").withColumn("score", identity.score(F.col("t"), F.col("q"), F.col("year"), F.col("wanted"), F.col("votes")))
    best = s.groupBy("qid").agg(F.max(F.struct("score", (-F.col("id")).alias("i"))).alias("x"))
    return best.select("qid", (-F.col("x.i")).alias("id"), F.round("x.score", 6).alias("score"))


@query("multi_hall", "WITH m AS (SELECT l_suppkey AS venue, l_shipdate, l_linenumber FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_partkey % 7) >= 2) SELECT venue, count(*) AS moments FROM m GROUP BY 1 HAVING count(*) >= 2")
def multi_hall(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("venue"), F.col("l_shipdate").alias("date"), F.col("l_linenumber").alias("time"), F.col("l_partkey").alias("item"), (F.col("l_partkey") % 7).alias("kind"))
    return identity.multi_hall(d, F.col("kinds") >= 2)


@query("name_similarity")
def name_similarity(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    alike = identity.alike_names(p, "p_size", "p_name", 0.72)
    d = alike.join(p.select(F.col("p_partkey").alias("a"), F.col("p_name").alias("x"), "p_size"), ["x", "p_size"]).join(p.select(F.col("p_partkey").alias("b"), F.col("p_name").alias("y"), "p_size"), ["y", "p_size"])
    return d.filter("a < b").select("a", "b", F.round("ratio", 6).alias("ratio"))


@query("url_host_site", r"SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', '') AS host, regexp_extract(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', ''), '([^.]+\.[^.]+)$', 1) AS site FROM pages")
def url_host_site(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.host(F.col("url")).alias("host"), urls.site(F.col("url")).alias("site"))


_H = r"regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', '')"
_STEM = r"regexp_replace(regexp_extract(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), '\.[^.]*$', '')"


@query("reject_reason", f"""SELECT page_id, CASE WHEN coalesce(url, '') = '' THEN 'empty value' WHEN NOT starts_with(url, 'https://') THEN 'not https' WHEN {_H} = '' THEN 'no host' WHEN {_H} IN ('free-bets.example.com', 'spam-farm.example.org') OR {_H} LIKE '%.free-bets.example.com' OR {_H} LIKE '%.spam-farm.example.org' THEN 'distrusted host' WHEN regexp_matches({_STEM}, '^[0-9]{{3}}$') THEN 'opaque name' WHEN regexp_matches(lower(url), 'ref=x') THEN 'placeholder' END AS reason FROM pages""")
def reject_reason(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.reject_reason(F.col("url"), ["free-bets.example.com", "spam-farm.example.org"], "ref=x", "^[0-9]{3}$").alias("reason"))


@query("scrub_text", r"SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '(?i)\b(api_?key|token|password|secret)=[^\s&]+', '\1=***', 'g'), '(?i)\b(authorization: *[a-z]+) +\S+', '\1 ***', 'g'), '(://)[^/\s:@]+:[^/\s@]+@', '\1***@', 'g')) AS scrubbed FROM documents")
def scrub_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.scrub(F.col("text")).cast("binary")).alias("scrubbed"))


_KINDS = [("shorts", "(?i)shorts|ring"), ("event", "(?i)event|gear"), ("live", "(?i)live|bolt")]


@query("classify_titles", "SELECT p_partkey, CASE WHEN regexp_matches(p_name, '(?i)shorts|ring') THEN 'shorts' WHEN regexp_matches(p_name, '(?i)event|gear') THEN 'event' WHEN regexp_matches(p_name, '(?i)live|bolt') THEN 'live' ELSE 'film' END AS class FROM part")
def classify_titles(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.first_of(F.col("p_name"), _KINDS, "film").alias("class"))


_HEAD = "CASE WHEN contains(substr(text, 1, 100), ' ') THEN regexp_extract(substr(text, 1, 100), '(?s)^(.*) ', 1) ELSE substr(text, 1, 100) END"


@query("truncate_words", f"SELECT doc_id, CASE WHEN length(text) <= 100 THEN text ELSE rtrim({_HEAD}, '.,;:—–') || '…' END AS short FROM documents")
def truncate_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.truncate(F.col("text"), 100).alias("short"))


@query("compact_votes", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '491.7K' WHEN 1 THEN '2.0M' WHEN 2 THEN p_size::VARCHAR ELSE p_size || '.0K' END AS votes FROM part")
def compact_votes(spark, sf):
    k, n = F.col("p_partkey") % 4, F.col("p_size")
    v = F.when(k == 0, 491_700).when(k == 1, 2_000_000).when(k == 2, n).otherwise(n * 1000)
    return table(spark, sf, "part").select("p_partkey", text.compact_votes(v).alias("votes"))


@query("hash_colours", "SELECT p_partkey, CAST('0x' || substr(sha1(p_name), 1, 8) AS BIGINT) % 360 AS hue FROM part")
def hash_colours(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.colour(F.col("p_name")).alias("hue"))


@query("html_title_links", r"""WITH l AS (SELECT *, list_transform(regexp_extract_all(html, '(?i)\bhref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), lambda x: regexp_replace(x, '^["'']|["'']$', '', 'g')) AS ls FROM pages)
SELECT page_id, regexp_extract(html, '(?is)<title(?:\s[^>]*)?>(.*?)</title>', 1) AS title, len(regexp_extract_all(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1>', 1)) AS headings, len(ls) AS links, md5(array_to_string(ls, ' ')) AS links_md5 FROM l""")
def html_title_links(spark, sf):
    h = F.col("html")
    return table(spark, sf, "pages").select("page_id", html.title(h).alias("title"), F.size(html.headings(h)).alias("headings"), F.size(html.links(h)).alias("links"), F.md5(F.array_join(html.links(h), " ").cast("binary")).alias("links_md5"))


@query("prose_lead")
def prose_lead(spark, sf):
    return table(spark, sf, "pages").select("page_id", html.lead("html").alias("lead"), F.size(html.paragraphs("html")).alias("paragraphs"))


_STATE = "event_id, CASE WHEN event_id % 5 = 0 THEN 'x' || event_id ELSE ts::DATE::VARCHAR END AS last_ok, CASE WHEN event_id % 7 = 0 THEN '2024-13-01' WHEN event_id % 2 = 0 THEN '2024-02-01' END AS covered_to, event_type"


@query("sanitised_state", f"SELECT event_id, TRY_CAST(last_ok AS DATE)::VARCHAR AS last_ok, TRY_CAST(covered_to AS DATE)::VARCHAR AS covered_to FROM (SELECT {_STATE} FROM events) WHERE event_type <> 'error'")
def sanitised_state(spark, sf):
    return _sanitised(spark, sf)[0]


@query("dropped_state", f"WITH s AS (SELECT {_STATE} FROM events) SELECT event_id, 'entry' AS part FROM s WHERE event_type = 'error' UNION ALL SELECT event_id, 'last_ok' FROM s WHERE event_type <> 'error' AND TRY_CAST(last_ok AS DATE) IS NULL UNION ALL SELECT event_id, 'covered_to' FROM s WHERE event_type <> 'error' AND covered_to IS NOT NULL AND TRY_CAST(covered_to AS DATE) IS NULL")
def dropped_state(spark, sf):
    return _sanitised(spark, sf)[1]


def _sanitised(spark, sf):
    k = F.col("event_id")
    e = table(spark, sf, "events").select("event_id", F.when(k % 5 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(F.col("ts").cast("date").cast("string")).alias("last_ok"), F.when(k % 7 == 0, "2024-13-01").when(k % 2 == 0, "2024-02-01").alias("covered_to"), "event_type")
    good, bad = sources.sanitised(e, "event_id", {c: f"try_to_date({c}, 'yyyy-MM-dd') is not null" for c in ("last_ok", "covered_to")}, "event_type <> 'error'")
    return good.drop("event_type"), bad


@query("json_sidecars", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM events")
def json_sidecars(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 > 0, F.col("props")).when(F.col("event_id") % 2 == 0, "{broken").otherwise("[1]").alias("t"))
    return sources.json_sidecar(e, "t", "k int").select("event_id", "value.k")


@query("embedded_constant", "SELECT n_name AS name, n_regionkey::VARCHAR AS region FROM nation")
def embedded_constant(spark, sf):
    n = table(spark, sf, "nation").select(F.concat(F.lit("/* [ */ const ROWS = [ // ]\n [\""), "n_name", F.lit("\", "), F.col("n_regionkey").cast("string"), F.lit(", \"]\"],];\nconst B = [];")).alias("script"))
    return sources.embedded_rows(n, "script", "ROWS").select(F.col("row")[0].alias("name"), F.col("row")[1].alias("region"))


@query("event_windows", "SELECT CAST(ts AS DATE)::VARCHAR AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def event_windows(spark, sf):
    d = streaming.run_to_table(streaming.windowed_counts(streaming.events_stream(spark, f"{sf}/events.parquet"), "ts", "event_type"), ["day", "event_type"])
    return d.withColumn("day", F.col("day").cast("string"))
