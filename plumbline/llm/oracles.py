"""SQL that gives the same rows as the queries, for a small database."""

from __future__ import annotations

from plumbline.llm import quality, secrets

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def quality_sql() -> str:
    classes = quality._CLASSES
    own = [f"length(letters) - length(regexp_replace(letters, '(?:{p.replace(chr(39), chr(39) * 2)})+', '', 'g')) AS c_{k}" for k, p in classes.items()]
    langs = list(quality.COMMON)
    common = "CASE lang " + " ".join(f"WHEN '{k}' THEN {[*quality.COMMON[k].split()]!r}" for k in langs) + " END"
    return rf"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, lang IS NULL AS nolang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, nolang, t, regexp_extract_all(t, '{_WORD}') AS words FROM d),
own AS (SELECT lang AS name, list_resize(list(x ORDER BY n DESC, x), {quality.LISTED}, '{quality._NONE}') AS listed FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, x) AS k FROM (SELECT lang, x, count(*) AS n FROM (SELECT lang, unnest(list_distinct(list_transform(words, lambda x: rtrim(lower(x), '.,;:!?')))) AS x FROM w WHERE NOT nolang AND lang NOT IN ({", ".join(repr(k) for k in quality.COMMON)}) AND len(words) >= 10) GROUP BY 1, 2)) WHERE k <= {quality.LISTED} GROUP BY 1),
l AS (SELECT *, array_to_string(words, '') AS letters, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines, coalesce({common}, listed) AS common, list_transform(words, lambda x: rtrim(lower(x), '.,;:!?')) AS bare FROM w LEFT JOIN own ON lang = name AND NOT nolang),
m AS (SELECT *, len(words) AS n_words, length(letters) AS word_chars, {", ".join(own)}, len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM l),
s AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g FROM m, unnest(range(1, n_words - 3)) u(i) WHERE n_words >= 5),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS k FROM s), range(5) x(j) WHERE k > 1 GROUP BY 1),
a AS (SELECT m.*, coalesce(r.n, 0) AS n_repeat_words, n_words < 10 OR 100 * coalesce(r.n, 0) > 20 * n_words AS base_failed,
  [{", ".join(f"c_{k}" for k in classes)}, word_chars - {" - ".join(f"c_{k}" for k in classes)}] AS classes, list_transform(common, lambda x: len(list_filter(bare, lambda y: y = x))) AS hits FROM m LEFT JOIN r USING (doc_id)),
b AS (SELECT *, CASE WHEN common IS NOT NULL THEN list_append(hits, greatest(0, n_words - list_sum(hits)::BIGINT)) END AS commons FROM a),
ref AS (SELECT lang, nolang, count(*) AS texts, [{", ".join(f"sum(classes[{i + 1}])" for i in range(len(classes) + 1))}]::DOUBLE[] AS rc, [{", ".join(f"sum(commons[{i + 1}])" for i in range(18))}]::DOUBLE[] AS rw FROM b WHERE NOT base_failed GROUP BY 1, 2),
p AS (SELECT b.*, texts, list_transform(classes, lambda x: x / word_chars) AS pc, list_transform(rc, lambda x: x / list_sum(rc)) AS qc, list_transform(commons, lambda x: x / n_words) AS pw, list_transform(list_filter(rw, lambda x: x IS NOT NULL), lambda x: x / list_sum(rw)) AS qw FROM b LEFT JOIN ref ON b.lang = ref.lang AND b.nolang = ref.nolang),
j AS (SELECT *, CASE WHEN texts >= {quality.MIN_REFERENCE} AND word_chars >= {quality.MIN_CHARS} THEN {_js("pc", "qc")} END AS js_classes, CASE WHEN texts >= {quality.MIN_REFERENCE} AND n_words >= {quality.MIN_WORDS} AND pw IS NOT NULL THEN {_js("pw", "qw")} END AS js_common FROM p)
SELECT doc_id, n_words, word_chars, c_symbol AS n_symbols, n_dup_lines, n_repeat_words, base_failed, round(js_classes, 4) AS js_classes, round(js_common, 4) AS js_common,
  NOT base_failed AND coalesce(js_classes <= {quality.MOST_CLASSES}, true) AND coalesce(js_common <= {quality.MOST_COMMON}, true) AS kept FROM j"""


def _js(p: str, q: str) -> str:
    terms = "CASE WHEN x[1] > 0 THEN x[1] * log2(2 * x[1] / (x[1] + x[2])) ELSE 0 END + CASE WHEN x[2] > 0 THEN x[2] * log2(2 * x[2] / (x[1] + x[2])) ELSE 0 END"
    return f"sqrt(greatest(0, list_sum(list_transform(list_zip({p}, {q}), lambda x: {terms})) / 2))"


SHARDS = f"""WITH RECURSIVE bits AS (SELECT n, n AS c, 0 AS k FROM range(256) r(n) UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
e AS (SELECT doc_id, source, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) + 1 AS size FROM documents),
x AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, size), lambda i: ('0x' || hx[2 * i - 1:2 * i])::BIGINT)), lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) AS text_crc32 FROM (SELECT *, hex(encode(text)) AS hx FROM e), crc),
d AS (SELECT e.*, text_crc32, md5('20:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size || ':' || text_crc32) AS h FROM e JOIN x USING (doc_id)),
r AS (SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY h, doc_id) - 1) / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS part FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY part, CASE WHEN source IS NULL THEN '' ELSE 's' || source END, h, doc_id) - 1 AS pos, count(*) OVER () AS n FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(pos * 16 // n AS INTEGER) AS shard, pos - ((pos * 16 // n) * n + 15) // 16 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p"""


def secrets_sql() -> str:
    each = []
    for order, r in enumerate(secrets.RULES):
        p = r.pattern.replace("'", "''")
        each.append(
            f"SELECT doc_id, {order} AS ord, '{r.kind}' AS kind, list_sum(list_transform(gaps[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0)::BIGINT AS start, length(hits[i]) AS n "
            f"FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS hits, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}', {r.group}) AS tested FROM documents WHERE regexp_matches(text, '{p}')), unnest(range(1, len(hits) + 1)) u(i) WHERE length(tested[i]) >= {r.least}"
        )
    base = ", ".join(f"'{r.kind}'" for r in secrets.BASE)
    span = "string_agg({0} kind || ':' || start || ':' || (start + n), ',' ORDER BY start, ord)"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    return f"""WITH f AS ({" UNION ALL ".join(each)})
SELECT doc_id, {counts}, sha256(coalesce({span.format("")} FILTER (kind IN ({base})), '')) AS base_sha256, coalesce({span.format("")}, '') AS spans FROM documents LEFT JOIN f USING (doc_id) GROUP BY doc_id"""


def urls_sql(rules: tuple[tuple[str, str, str], ...]) -> str:
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return rf"""WITH p AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {_UPPER}), '') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT * FROM (VALUES {values}) r(verdict, h, q)),
m AS (SELECT page_id, h || q AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || q) DESC) AS n FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m ON m.page_id = p.page_id AND n = 1"""


JACCARD = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), '{_WORD}') AS words FROM documents),
g AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')] ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n_shingles FROM g), e AS (SELECT doc_id, unnest(s) AS x FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n_shingles + nb.n_shingles - k)),
s AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT doc_id, doc_id AS reach FROM n UNION SELECT r.doc_id, s.b FROM r JOIN s ON s.a = r.reach)
SELECT doc_id, n_shingles, min(reach) AS component_id FROM r JOIN n USING (doc_id) GROUP BY 1, 2"""


REPEATS = """WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS hx FROM documents),
w AS (SELECT doc_id, p, md5(substr(hx, 2 * p + 1, 200)) AS h FROM d, unnest(range(0, octet_length(b) - 99)) u(p)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS n FROM w) WHERE n > 1),
g AS (SELECT doc_id, p, sum(CASE WHEN p - 100 <= prev THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM (SELECT *, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS prev FROM r)),
s AS (SELECT doc_id, k, min(p) AS lo, max(p) + 100 AS hi FROM g GROUP BY 1, 2),
x AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS since FROM s),
k AS (SELECT d.doc_id, count(lo) AS n_spans, coalesce(sum(hi - lo), 0)::BIGINT AS n_removed, coalesce(string_agg(substr(hx, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo), '') AS head, coalesce(max(hi), 0) AS upto FROM d LEFT JOIN x ON x.doc_id = d.doc_id GROUP BY 1)
SELECT doc_id, octet_length(b) AS n_bytes, n_removed, n_spans, sha256(unhex(head || substr(hx, 2 * upto + 1))) AS kept_sha256 FROM d JOIN k USING (doc_id)"""
