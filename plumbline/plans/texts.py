"""Text, date and row rules on values that are built so that SQL knows the answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import dates, listing, text, urls
from plumbline.operators import identity
from plumbline.registry import query
from plumbline.session import table

P = "p_partkey % {}"


def _choose(column, *options):
    """The option of a row by its key's remainder."""
    out = F.lit(None).cast("string")
    for i, o in enumerate(options):
        out = F.when(column % len(options) == i, o).otherwise(out)
    return out


def _part(spark, sf):
    return table(spark, sf, "part"), F.col("p_partkey"), F.col("p_name")


@query("clean_titles", """SELECT p_partkey, p_name AS cleaned, CASE WHEN p_partkey % 8 IN (1, 2) THEN p_partkey % 8 END AS kind FROM part""")
def clean_titles(spark, sf):
    p, k, n = _part(spark, sf)
    c = F.concat
    noisy = _choose(k, n, c(F.lit("СИНЕЛИБРИ 2026 – "), n), c(F.lit("40. Киномания: "), n), c(n, F.lit(" - CINELIBRI")), c(F.lit("  Премиера: "), n, F.lit(" (3D, IMAX)")), c(n, F.lit(" [бг субтитри] – премиера")), c(F.lit("Хелоуин Селекция "), n, F.lit(" Dolby Atmos")), c(n, F.lit(" 4DX – ")))
    d = p.select("p_partkey", noisy.alias("t"))
    kind = F.when(text.clean_title(F.col("t")) != text.clean_title(F.col("t"), keep_prefix=True), F.col("p_partkey") % 8)
    return d.select("p_partkey", text.clean_title(F.col("t")).alias("cleaned"), F.when(kind.isin(1, 2), kind).alias("kind"))


@query("core_titles", "SELECT p_partkey, CASE p_partkey % 5 WHEN 3 THEN p_name || ' (1990' WHEN 4 THEN 'Anna Magnani: ' || p_name ELSE p_name END AS core, CASE WHEN p_partkey % 5 < 3 THEN 1950 + p_size END AS year FROM part")
def core_titles(spark, sf):
    p, k, n = _part(spark, sf)
    y = (F.col("p_size") + 1950).cast("string")
    t = _choose(k, F.concat(n, F.lit(" ("), y, F.lit(")")), F.concat(F.lit("Anna Magnani: "), n, F.lit(" | "), y, F.lit(" |")), F.concat(n, F.lit(" | "), y), F.concat(n, F.lit(" (1990")), F.concat(F.lit("Anna Magnani: "), n))
    d = p.select("p_partkey", t.alias("t"))
    return d.select("p_partkey", text.core_title(text.clean_title(F.col("t"))).alias("core"), text.title_year(text.clean_title(F.col("t"))).alias("year"))


@query("shop_title_keys", "SELECT p_partkey, list_reduce(list_sort(list_distinct([p_name || ' ' || lower(p_type), p_name, lower(p_type)])), lambda a, b: a || ',' || b) AS keys FROM part")
def shop_title_keys(spark, sf):
    p, _, n = _part(spark, sf)
    return p.select("p_partkey", F.concat(n, F.lit(" / "), "p_type").alias("t")).select("p_partkey", F.array_join(text.title_keys(F.col("t")), ",").alias("keys"))


@query("version_notes", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'en-sub' END AS note, p_name AS bare, p_name || CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' с английски субтитри' ELSE ' with english subtitles' END AS main FROM part")
def version_notes(spark, sf):
    p, k, n = _part(spark, sf)
    d = p.select("p_partkey", _choose(k, n, F.concat(n, F.lit(" (с английски субтитри)")), F.concat(n, F.lit(" with English subtitles"))).alias("t"))
    return d.select("p_partkey", text.version_note(F.col("t")).alias("note"), text.key_without_note(F.col("t")).alias("bare"), text.main_key(F.col("t")).alias("main"))


@query("normalisers", """SELECT p_partkey, 'tom ' || CASE WHEN true THEN 'and ' END || p_name || 's ' || lower(p_type) || ' елка и' AS key, 'tom & ' || p_name || ' s ' || lower(p_type) || ' елка ѝ' AS plain, 'tom ' || p_name || ' s ' || lower(p_type) || ' елка и' AS event,
'tom & ' || p_name || ' s ' || lower(p_type) || ' елка ѝ' AS mirror, regexp_replace('tom' || p_name || 's' || lower(p_type), '[^a-z0-9]', '', 'g') AS latin FROM part""")
def normalisers(spark, sf):
    p, _, n = _part(spark, sf)
    t = F.concat(F.lit("TOM & "), n, F.lit("'s „"), "p_type", F.lit("“ – Ёлка, ѝ!"))
    t_latin = F.concat(F.lit("TOM & "), n, F.lit("'s „"), "p_type", F.lit("“"))
    d = p.select("p_partkey", t.alias("t"), t_latin.alias("l"))
    # the key's ampersand is spelt by the script of the text, which holds Cyrillic letters here
    key = F.replace(text.fold_marks(F.col("t"), "key"), F.lit(" и "), F.lit(" and "))
    return d.select("p_partkey", key.alias("key"), *[text.fold_marks(F.col("t"), x).alias(x) for x in ("plain", "event", "mirror")], text.latin_norm(F.col("l")).alias("latin"))


@query("show_keys", "SELECT p_partkey, p_name || ' бал' AS key, CASE WHEN p_partkey % 5 = 2 THEN 'ДТ-Русе' END AS guest FROM part")
def show_keys(spark, sf):
    p, k, n = _part(spark, sf)
    base = F.concat(n, F.lit(" бал"))
    t = _choose(k, F.concat(base, F.lit(" | ПРЕМИЕРА")), F.concat(F.lit("„"), n, F.lit(" бaл“ 16+")), F.concat(base, F.lit(" - Гостува ДТ-Русе")), F.concat(F.lit("Програма „Бекет“ "), base), F.concat(base, F.lit(" (ОТМЕНЕНО) - представление № 200")))
    d = p.select("p_partkey", t.alias("t"))
    return d.select("p_partkey", text.show_key(F.col("t")).alias("key"), text.split_guest(F.col("t"))[1].alias("guest"))


@query("display_titles", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || ' Балдахинът' WHEN 1 THEN p_name ELSE 'Neoдачници ' || p_name END AS shown FROM part")
def display_titles(spark, sf):
    p, k, n = _part(spark, sf)
    t = _choose(k, F.concat(F.lit("\""), n, F.lit(" Бaлдaхинът\" ")), F.concat(F.lit(" | "), n, F.lit(" – премиера")), F.concat(F.lit("Neoдачници "), n))
    return p.select("p_partkey", t.alias("t")).select("p_partkey", text.display_title(F.col("t")).alias("shown"))


@query("romanised", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Sofia ' || p_name WHEN 1 THEN 'SHTE ' || p_name WHEN 2 THEN 'Zhaba ' || p_name ELSE p_name END AS roman FROM part")
def romanised(spark, sf):
    p, k, n = _part(spark, sf)
    t = _choose(k, F.concat(F.lit("София "), n), F.concat(F.lit("ЩЕ "), n), F.concat(F.lit("Жаба "), n), n)
    return p.select("p_partkey", t.alias("t")).select("p_partkey", text.romanise(F.col("t")).alias("roman"))


@query("script_shares", "SELECT p_partkey, length(replace(p_name, ' ', '')) AS latin, round(CASE WHEN p_partkey % 2 = 0 THEN 3.0 / (3 + length(replace(p_name, ' ', ''))) ELSE 0 END, 6) AS share, p_partkey % 2 = 0 AS cyrillic FROM part")
def script_shares(spark, sf):
    p, k, n = _part(spark, sf)
    d = p.select("p_partkey", F.length(F.replace(n, F.lit(" "), F.lit(""))).alias("latin"), F.when(k % 2 == 0, F.concat(n, F.lit(" бал"))).otherwise(n).alias("t"))
    return d.select("p_partkey", "latin", F.round(text.cyrillic_share(F.col("t")), 6).alias("share"), text.has_cyrillic(F.col("t")).alias("cyrillic"))


@query("decluttered", "SELECT p_partkey, CASE p_partkey % 5 WHEN 4 THEN 'Venom: ' || p_name ELSE p_name END AS title, CASE WHEN p_partkey % 5 IN (0, 2) THEN 1950 + p_size END AS year, p_partkey % 5 = 3 AS rerelease FROM part")
def decluttered(spark, sf):
    p, k, n = _part(spark, sf)
    y = (F.col("p_size") + 1950).cast("string")
    t = _choose(k, F.concat(F.lit("Jean Luc Godard: "), n, F.lit(" ("), y, F.lit(")")), F.concat(F.lit("ЕВРОПЕЙСКИ КИНОКЛАСИКИ: "), n), F.concat(F.lit("ФИЛМОВА ПАНОРАМА – "), n, F.lit(" | "), y, F.lit(" |")), F.concat(n, F.lit(" – Специално издание")), F.concat(F.lit("Venom: "), n))
    d = p.select("p_partkey", t.alias("t"))
    title, year = text.declutter(F.col("t"))
    return d.select("p_partkey", title.alias("title"), year.alias("year"), text.rerelease(F.col("t")).alias("rerelease"))


@query("safe_ids", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'film-' || substr(md5('…' || ''), 1, 8) WHEN p_partkey % 3 = 1 THEN replace(p_name, ' ', '-') ELSE 'zhaba-' || replace(p_name, ' ', '-') END AS id FROM part")
def safe_ids(spark, sf):
    p, k, n = _part(spark, sf)
    return p.select("p_partkey", text.safe_id(_choose(k, F.lit("…"), n, F.concat(F.lit("Жаба – "), n)), "film").alias("id"))


_DIGITS = "list_transform(string_split(md5(p_name), ''), lambda c: strpos('0123456789abcdef', c) - 1)"


@query("gradient_picks", f"SELECT p_partkey, list_reduce(list_prepend(0, {_DIGITS}), lambda a, d: (a * 16 + d) % 9)::INTEGER AS pick FROM part")
def gradient_picks(spark, sf):
    p, _, n = _part(spark, sf)
    return p.select("p_partkey", text.pick(n, 9).alias("pick"))


@query("script_json", r"""SELECT p_partkey, '{"t":"\u003c/script\u003e \u0026 ' || p_name || '","k":' || p_partkey || '}' AS json FROM part""")
def script_json(spark, sf):
    p, k, n = _part(spark, sf)
    return p.select("p_partkey", text.for_script(F.to_json(F.struct(F.concat(F.lit("</script> & "), n).alias("t"), k.alias("k")))).alias("json"))


@query("credit_lines", "SELECT p_partkey, 'Чехия/' || upper(p_type) AS countries, 1950 + p_size AS year, 60 + p_size AS runtime, p_name AS people FROM part")
def credit_lines(spark, sf):
    p, k, n = _part(spark, sf)
    y, r = (F.col("p_size") + 1950).cast("string"), (F.col("p_size") + 60).cast("string")
    t = _choose(k, F.concat(F.lit("Чехия и "), F.upper("p_type"), F.lit(" ("), y, F.lit(")")), F.concat(F.lit("Чехия, "), F.upper("p_type"), F.lit(", "), y, F.lit(", "), r, F.lit(" мин.")))
    d = p.select("p_partkey", t.alias("t"), F.concat(F.lit("Цвят, "), r, F.lit(" мин")).alias("r"), F.concat(n, F.lit(" и др.")).alias("p"))
    countries, year = text.country_year(F.col("t"))
    return d.select("p_partkey", countries.alias("countries"), year.alias("year"), text.runtime_minutes(F.col("r")).alias("runtime"), text.people(F.col("p")).alias("people"))


@query("vote_counts", "SELECT o_orderkey, CASE WHEN v >= 1000000 THEN printf('%.1f', v / 1000000.0) || 'M' WHEN v >= 1000 THEN printf('%.1f', v / 1000.0) || 'K' ELSE v::VARCHAR END AS compact, CASE WHEN v < 1000 THEN v END AS back FROM (SELECT o_orderkey, CAST(floor(o_totalprice * CASE o_orderkey % 3 WHEN 0 THEN 0.001 WHEN 1 THEN 1 ELSE 16 END) AS BIGINT) // 8 * 8 AS v FROM orders)")
def vote_counts(spark, sf):
    k = F.col("o_orderkey") % 3
    v = F.floor(F.col("o_totalprice") * F.when(k == 0, 0.001).when(k == 1, 1).otherwise(16))
    d = table(spark, sf, "orders").select("o_orderkey", (F.floor(v / 8) * 8).cast("long").alias("v")).withColumn("compact", text.compact_votes(F.col("v")))
    return d.select("o_orderkey", "compact", F.when(F.col("v") < 1000, text.votes_number(F.col("compact"))).alias("back"))


@query("event_names", "SELECT p_partkey, upper(substr(n, 1, 1)) || substr(n, 2) AS name FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN 'Лятно кино ' || p_name ELSE p_name || ' фестивал' || CASE WHEN p_partkey % 4 = 2 THEN ' 2026' ELSE '' END END AS n FROM part)")
def event_names(spark, sf):
    p, k, n = _part(spark, sf)
    f = F.concat(n, F.lit(" фестивал"))
    t = _choose(k, F.concat(F.lit("Новини | Започва 16. издание на "), f), F.concat(f, F.lit(" идва на 21 ноември")), F.concat(f, F.lit(" 2026 със силен акцент")), F.concat(F.lit("Лятно кино "), n, F.lit(" | в двора")))
    return p.select("p_partkey", t.alias("t")).select("p_partkey", listing.event_name(F.col("t")).alias("name"))


@query("phrase_sentences", "SELECT p_partkey, ' Here ' || p_name || ' plays' AS sentence FROM part")
def phrase_sentences(spark, sf):
    p, _, n = _part(spark, sf)
    d = p.select("p_partkey", F.concat(F.lit("One thing. Here "), n, F.lit(" plays! Then no more.")).alias("t"), n.alias("n"))
    return d.select("p_partkey", listing.sentence_of(F.col("t"), F.col("n")).alias("sentence"))


@query("price_texts", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || ',50–' || (p_size + 4) || ',00 €' WHEN 1 THEN 'от ' || p_size || ',00 €' WHEN 2 THEN 'вход свободен' END AS price FROM part")
def price_texts(spark, sf):
    p, k, _ = _part(spark, sf)
    s, t = F.col("p_size").cast("string"), (F.col("p_size") + 4).cast("string")
    said = _choose(k, F.concat(F.lit("от "), s, F.lit(".50 до "), t, F.lit(".00 €")), F.concat(F.lit("от "), s, F.lit(" EUR")), F.lit(" вход  свободен "), F.concat(s, F.lit(" лв.")))
    return p.select("p_partkey", said.alias("t")).select("p_partkey", listing.price_text(F.col("t")).alias("price"))


@query("screening_attributes", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'dub,3d' WHEN 1 THEN 'sub' WHEN 2 THEN 'imax,4dx' END AS attributes FROM part")
def screening_attributes(spark, sf):
    p, k, _ = _part(spark, sf)
    sets = F.array(*[F.array(*map(F.lit, x)) for x in (["2d", "dubbed", "3d"], ["first-subbed-lang-bg", "subbed"], ["bulgarian", "subbed", "imax", "4dx"], ["2d", "first-subbed-lang-bg-cc"])])
    return p.select("p_partkey", listing.screening_attributes(F.get(sets, (k % 4).cast("int"))).alias("attributes"))


@query("listed_rows", "SELECT p_partkey, p_name || CASE p_partkey % 3 WHEN 0 THEN ' – премиера' WHEN 1 THEN ' предпремиера' ELSE '' END AS title, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS hall, p_partkey % 3 = 0 AS premiere, p_partkey % 3 = 1 AS preview FROM part")
def listed_rows(spark, sf):
    p, k, n = _part(spark, sf)
    raw = p.select(F.concat(n, F.lit("  "), _choose(k, F.lit("– премиера"), F.lit("предпремиера"), F.lit(""))).alias("title"), k.alias("date"), F.lit("19:00").alias("time"), F.when(k % 2 == 0, F.col("p_brand")).otherwise("  ").alias("hall"), F.lit("").alias("price"), F.lit(None).cast("string").alias("url"))
    return listing.row_of(raw).select(F.col("date").alias("p_partkey"), "title", "hall", "premiere", "preview")


_GENRES = {"драма": "Драма", "комедия": "Комедия", "екшън": "Екшън"}


@query("genre_words", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Драма,Екшън' WHEN 1 THEN 'Комедия' ELSE '' END AS genres FROM part")
def genre_words(spark, sf):
    p, k, _ = _part(spark, sf)
    return p.select("p_partkey", F.array_join(listing.genres(_choose(k, F.lit("Драма, екшън / ДРАМА"), F.lit("комедия; поезия"), F.lit("друго")), _GENRES), ",").alias("genres"))


@query("venue_names", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'app' WHEN s_suppkey % 4 < 3 THEN 'outside' ELSE 'unknown' END AS kind, CASE WHEN s_suppkey % 4 = 0 THEN 'g8' END AS venue FROM supplier")
def venue_names(spark, sf):
    s, k = table(spark, sf, "supplier"), F.col("s_suppkey")
    kind, vid = listing.venue_of(_choose(k, F.lit("Културен  център „G8“"), F.lit("Кино Пловдив"), F.lit("Зала Отвън"), F.concat(F.lit("Зала "), "s_name")), {"културен център g8": "g8"}, ("зала отвън",))
    return s.select("s_suppkey", kind.alias("kind"), vid.alias("venue"))


@query("own_slugs", "SELECT page_id, url AS was, CASE WHEN contains(url, 'example.com') THEN 'rewritten' ELSE url END AS now FROM pages")
def own_slugs(spark, sf):
    d = table(spark, sf, "pages").select("page_id", F.col("url").alias("was"), listing.own_slug(F.col("url"), F.lit("park"), "page", "example.com").alias("now"))
    good = F.col("now").rlike(r"[?&]page=park(#|$)") & ~F.col("now").rlike(r"page=\d")
    return d.withColumn("now", F.when(F.col("was").contains("example.com") & good, "rewritten").otherwise(F.col("now")))


@query("headline_dates", """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '2026-11-' || lpad(d::VARCHAR, 2, '0') WHEN 1 THEN '2026-10-' || lpad(d::VARCHAR, 2, '0') WHEN 2 THEN '2026-10-28' END AS first,
CASE p_partkey % 4 WHEN 0 THEN '2026-11-' || lpad(d::VARCHAR, 2, '0') WHEN 1 THEN '2026-10-' || lpad((d + 3)::VARCHAR, 2, '0') WHEN 2 THEN '2026-11-' || lpad(d::VARCHAR, 2, '0') END AS last,
CASE p_partkey % 4 WHEN 0 THEN d || ' ноември 2026' WHEN 1 THEN d || '–' || (d + 3) || ' октомври 2026' WHEN 2 THEN '28 октомври – ' || d || ' ноември 2026' END AS words FROM (SELECT *, 1 + p_size % 20 AS d FROM part)""")
def headline_dates(spark, sf):
    p, k, n = _part(spark, sf)
    d, e = (F.col("p_size") % 20 + 1).cast("string"), (F.col("p_size") % 20 + 4).cast("string")
    t = _choose(k, F.concat(n, F.lit(" идва на "), d, F.lit(" ноември")), F.concat(n, F.lit(" "), d, F.lit("–"), e, F.lit(" октомври")), F.concat(n, F.lit(" 28 октомври – "), d, F.lit(" Ноември")), F.concat(n, F.lit(" 1 май и 2 юни")))
    first, last = dates.headline_dates(F.col("t"), F.lit("2026-09-20").cast("date"))
    x = p.select("p_partkey", t.alias("t")).select("p_partkey", first.alias("first"), last.alias("last"))
    return x.select("p_partkey", F.col("first").cast("string").alias("first"), F.col("last").cast("string").alias("last"), dates.date_words(F.col("first"), F.col("last")).alias("words"))


@query("field_dates", "SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS first, (o_orderdate::DATE + CAST(o_custkey % 40 AS INTEGER))::VARCHAR AS last, CASE WHEN o_orderdate::DATE - DATE '1998-01-01' = 1 THEN 'СЛЕД 1 ДЕН' ELSE 'СЛЕД ' || greatest(0, o_orderdate::DATE - DATE '1998-01-01') || ' ДНИ' END AS tag FROM orders")
def field_dates(spark, sf):
    a = F.col("o_orderdate").cast("date")
    b = F.date_add(a, (F.col("o_custkey") % 40).cast("int"))

    def words(d):
        return F.concat_ws(" ", F.dayofmonth(d).cast("string"), F.element_at(F.array(*map(F.lit, dates.MONTHS)), F.month(d)), F.year(d).cast("string"))

    o = table(spark, sf, "orders").select("o_orderkey", F.concat(words(a), F.lit(" - "), words(b)).alias("t"))
    first, last = dates.field_dates(F.col("t"))
    return o.select("o_orderkey", first.cast("string").alias("first"), last.cast("string").alias("last"), dates.countdown(first, F.lit("1998-01-01").cast("date")).alias("tag"))


_SUMMER = "CASE WHEN o_orderdate >= make_timestamp(y, 3, 31 - CAST(dayofweek(make_date(y, 3, 31)) AS INTEGER), 1, 0, 0) AND o_orderdate < make_timestamp(y, 10, 31 - CAST(dayofweek(make_date(y, 10, 31)) AS INTEGER), 1, 0, 0) THEN 3 ELSE 2 END"


@query("offset_stamps", f"SELECT o_orderkey, strftime(o_orderdate + to_hours({_SUMMER}), '%Y-%m-%dT%H:%M:%S') || '+0' || {_SUMMER} || ':00' AS stamp, strftime(date_trunc('month', o_orderdate) + INTERVAL 5 MONTH, '%Y-%m-%d') AS sixth FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)")
def offset_stamps(spark, sf):
    ts = F.col("o_orderdate").cast("timestamp")
    months = dates.months_from(F.col("o_orderdate").cast("date"))
    return table(spark, sf, "orders").select("o_orderkey", dates.offset_stamp(ts).alias("stamp"), F.get(months, F.lit(5)).cast("string").alias("sixth"))


@query("link_hosts", "SELECT page_id, contains(url, '.example.com/') OR contains(url, '/example.com/') AS listed FROM pages")
def link_hosts(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.host_in(F.col("url"), ["example.com"]).alias("listed"))


@query("safe_images", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'posters/p' || p_partkey || '.jpg' WHEN 1 THEN 'https://a.bg/' || p_partkey || '.png' WHEN 2 THEN 'data:image/png;base64,AA' END AS shown, p_partkey % 5 = 0 AS local FROM part")
def safe_images(spark, sf):
    p, k, _ = _part(spark, sf)
    s = k.cast("string")
    u = _choose(k, F.concat(F.lit("posters/p"), s, F.lit(".jpg")), F.concat(F.lit(" https://a.bg/"), s, F.lit(".png")), F.lit("data:image/png;base64,AA"), F.lit("javascript:alert(1)"), F.lit("//evil.bg/x.png"))
    return p.select("p_partkey", urls.safe_image(u).alias("shown"), urls.is_local(u).alias("local"))


@query("poster_reasons", """SELECT p_partkey, CASE p_partkey % 10 WHEN 0 THEN 'empty value' WHEN 1 THEN 'not https' WHEN 2 THEN 'no host' WHEN 3 THEN 'distrusted host' WHEN 4 THEN 'opaque name' WHEN 5 THEN 'logo' WHEN 6 THEN 'placeholder' WHEN 7 THEN 'screening of a catalogued film' WHEN 8 THEN 'unknown id' END AS reason FROM part""")
def poster_reasons(spark, sf):
    p, k, _ = _part(spark, sf)
    ok = F.lit("https://a.bg/poster-night.jpg")
    u = _choose(k, F.lit(""), F.lit("http://a.bg/x.jpg"), F.lit("https:///x.jpg"), F.lit("https://cdn.tickets.bg/x.jpg"), F.lit("https://a.bg/01234567890123456.jpg"), F.lit("https://a.bg/logo_small.png"), F.lit("https://a.bg/coming-soon.jpg"), ok, ok, F.lit("posters/logo_small.png"))
    reason = urls.reject_reason(u, ["tickets.bg"], r"coming[\s_-]*soon|sponsor|placeholder", r"^[0-9a-f]{16,}$|^[A-Za-z0-9+/_-]{24,}$", ["trusted.bg"], r"(?i)\blogo[_-]|[_-]logo\b|^logo$", F.when(k % 10 == 7, "film"), k % 10 != 8)
    return p.select("p_partkey", reason.alias("reason"))


_SCORE = "(o_custkey % 90) / 10.0 AS s, CASE WHEN o_orderkey % 7 > 0 THEN (o_orderkey * 37) % 2000 END AS v, (o_orderkey % 90) / 10.0 AS t, o_custkey % 40 AS c"


@query("scores_shown", f"SELECT o_orderkey, CASE WHEN v IS NULL THEN s WHEN v < 100 THEN NULL WHEN v < 1000 AND c >= 20 AND abs(s - t) >= 2 - 1e-9 THEN NULL ELSE s END AS imdb, CASE WHEN c >= 10 THEN t END AS tmdb FROM (SELECT o_orderkey, {_SCORE} FROM orders)")
def scores_shown(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    d = table(spark, sf, "orders").select("o_orderkey", ((c % 90) / 10.0).alias("s"), F.when(k % 7 > 0, (k * 37) % 2000).alias("v"), ((k % 90) / 10.0).alias("t"), (c % 40).alias("c"))
    return d.select("o_orderkey", listing.score_shown(F.col("s"), F.col("v"), F.col("t"), F.col("c")).alias("imdb"), listing.second_score(F.col("t"), F.col("c")).alias("tmdb"))


@query("score_reasons", """SELECT o_orderkey, CASE WHEN NOT m THEN CASE WHEN via THEN 'no TMDB match; ' || coalesce(low, 'no rating yet') WHEN i THEN 'no TMDB match, no rating for the venue''s id' ELSE 'no match' END
WHEN i THEN CASE WHEN low IS NOT NULL OR few IS NOT NULL THEN 'matched, below the floor: ' || concat_ws(', ', low, few) WHEN v IS NOT NULL THEN 'matched, no rating published' ELSE 'matched, no votes yet' END
ELSE CASE WHEN few IS NULL THEN 'matched without IMDb id, no votes yet' ELSE 'matched without IMDb id, below the floor: ' || few END END AS reason
FROM (SELECT o_orderkey, o_orderkey % 2 = 0 AS m, o_orderkey % 3 = 0 AS via, o_orderkey % 5 < 3 AS i, CASE WHEN o_custkey % 3 > 0 THEN o_custkey % 300 END AS v, CASE WHEN o_custkey % 3 > 0 AND o_custkey % 300 < 100 THEN 'few IMDb votes' WHEN o_custkey % 4 = 0 THEN 'stale IMDb rating' END AS low, CASE WHEN o_custkey % 7 > 0 THEN 'few TMDB votes' END AS few FROM orders)""")
def score_reasons(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    reason = listing.why_no_score(k % 2 == 0, F.when(k % 3 == 0, "omdb"), F.when(k % 5 < 3, "tt1"), F.when(c % 4 == 0, 5.0), F.when(c % 3 > 0, c % 300), c % 7, F.lit(None).cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", reason.alias("reason"))


_CATS = "list_distinct([o_orderpriority[1:1], (o_custkey % 6)::VARCHAR])"


@query("event_scopes", f"SELECT o_orderkey, CASE WHEN len(k) = 1 THEN k[1] WHEN len(k) = 2 THEN CASE WHEN len(s) = 1 THEN s[1] ELSE 'both' END END AS scope FROM (SELECT o_orderkey, list_sort(list_distinct(list_filter(list_transform(c, lambda x: CASE WHEN x IN ('1', '2') THEN 'cinema' WHEN x IN ('3', '4') THEN 'stage' END), lambda x: x IS NOT NULL))) AS k, list_filter(list_transform(c, lambda x: CASE x WHEN '2' THEN 'cinema' WHEN '4' THEN 'stage' END), lambda x: x IS NOT NULL) AS s FROM (SELECT o_orderkey, {_CATS} AS c FROM orders))")
def event_scopes(spark, sf):
    c = F.array_distinct(F.array(F.substring("o_orderpriority", 1, 1), (F.col("o_custkey") % 6).cast("string")))
    return table(spark, sf, "orders").select("o_orderkey", listing.scope(c, {"1": "cinema", "2": "cinema", "3": "stage", "4": "stage"}, {"2": "cinema", "4": "stage"}).alias("scope"))


@query("city_verdicts", "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'category' WHEN 1 THEN 'no: other category' WHEN 2 THEN 'no: headline' WHEN 3 THEN 'text' WHEN 4 THEN 'venue' ELSE 'no' END AS verdict FROM orders")
def city_verdicts(spark, sf):
    k = F.col("o_orderkey")
    cats = F.array(_choose(k, F.lit("sofia"), F.lit("varna"), *[F.lit("news")] * 4))
    head = _choose(k, F.lit("Варненско лято"), F.lit("София"), F.lit("Варненско лято"), F.lit("Фестивал"), F.lit("Фестивал"), F.lit("Фестивал"))
    body = _choose(k, *[F.lit("нещо")] * 3, F.lit("в софийски зали"), F.lit("в зала"), F.lit("Софиян"))
    venues = F.when(k % 6 == 4, F.array(F.lit("g8"))).otherwise(F.expr("cast(array() as array<string>)"))
    return table(spark, sf, "orders").select("o_orderkey", listing.in_city(cats, head, body, venues, ("sofia",), ("varna", "plovdiv")).alias("verdict"))


@query("record_checks", "SELECT p_partkey, p_partkey % 3 = 0 OR p_partkey % 4 = 0 AS needs, p_partkey % 5 = 0 OR p_partkey % 7 = 0 OR p_partkey % 11 = 0 AS stale, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS credit FROM part")
def record_checks(spark, sf):
    p, k, n = _part(spark, sf)
    needs = listing.needs_details(F.when(k % 3 > 0, 90), F.when(k % 4 > 0, n).otherwise(""), F.lit("text"), F.lit("BG"))
    stale = listing.stale_record(F.when(k % 5 == 0, F.concat(n, F.lit(" two"))).otherwise(F.concat(n, F.lit(" (3D)"))), n, F.when(k % 7 == 0, 1990).otherwise(2000), F.lit(2001), F.when(k % 11 == 0, "x Режисьор: y").otherwise("fine"))
    credit = listing.clean_credit(F.when(k % 2 == 0, F.concat(F.lit("Режисьор: "), n, F.lit(" (BG) и др."))).otherwise(" – "))
    return p.select("p_partkey", needs.alias("needs"), stale.alias("stale"), credit.alias("credit"))


@query("untranslated_titles", "SELECT p_partkey AS id, 'film' AS kind FROM part WHERE p_partkey % 3 < 2")
def untranslated_titles(spark, sf):
    p, k, n = _part(spark, sf)
    d = p.select(k.alias("id"), F.lit("film").alias("kind"), _choose(k, n, F.concat(F.lit("СИНЕЛИБРИ: "), n), F.concat(n, F.lit(" бал"))).alias("title"))
    return listing.without_native_title(d).select("id", "kind")


@query("event_blurbs", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Фестивал' WHEN p_partkey % 3 = 1 THEN 'Еднократно събитие' ELSE 'Поредица' END || ', ' || CASE WHEN p_partkey % 3 = 1 THEN '5' ELSE '5–9' END || ' юни 1998.' || CASE WHEN p_partkey % 2 = 0 THEN ' Сред местата: ' || p_brand || '.' ELSE '' END AS blurb FROM part")
def event_blurbs(spark, sf):
    p, k, _ = _part(spark, sf)
    first, last = F.lit("1998-06-05").cast("date"), F.when(k % 3 == 1, F.lit("1998-06-05")).otherwise(F.lit("1998-06-09")).cast("date")
    names = F.when(k % 2 == 0, F.array("p_brand")).otherwise(F.expr("cast(array() as array<string>)"))
    return p.select("p_partkey", listing.blurb(F.when(k % 3 == 0, "festival").otherwise("limited"), first, last, dates.date_words(first, last), names).alias("blurb"))


@query("same_titles", "SELECT p_partkey, p_partkey % 5 < 3 AS same FROM part")
def same_titles(spark, sf):
    p, k, n = _part(spark, sf)
    a = _choose(k, n, F.concat(n, F.lit(" живо съкровище")), F.lit("непознатата жена"), F.concat(F.lit("other "), n), F.lit("две"))
    b = _choose(k, n, n, F.lit("непозната жена"), n, F.lit("две три"))
    return p.select("p_partkey", text.same_words(a, b).alias("same"))


@query("names_agree")
def names_agree(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = F.array(*map(F.lit, ("Ферзан Йозпетек", "Jimmy Chin", "Джейкъб Чейс", "Ана Маняни", "Анна Каренина")))
    m = F.array(*map(F.lit, ("Ferzan Özpetek", "Jacob Chase", "Chin Jimmy, Elizabeth Vasarhelyi", "Anna Magnani", "")))
    return c.select("c_custkey", identity.names_agree(F.get(n, F.col("c_nationkey") % 5), F.get(m, (F.col("c_custkey") % 5).cast("int"))).alias("agree"))


@query("titles_agree")
def titles_agree(spark, sf):
    p, k, n = _part(spark, sf)
    return p.select("p_partkey", identity.titles_agree(n, _choose(k, F.concat(F.lit("The "), n), F.concat(n, F.lit("s")), F.lit("Other"), F.lit(""))).alias("agree"))


@query("nfc_titles", "SELECT p_partkey, nfc_normalize(p_name || ' и' || chr(774) || ' e' || chr(769)) AS title FROM part")
def nfc_titles(spark, sf):
    p, _, n = _part(spark, sf)
    return p.select("p_partkey", F.concat(n, F.lit(" й é")).alias("t")).select("p_partkey", text.nfc("t").alias("title"))


@query("plausible_years", "SELECT o_orderkey, CASE WHEN a IS NULL OR b IS NULL OR abs(a - b) <= 5 THEN true ELSE o_orderkey % 2 = 0 AND b <= a END AS fine FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 > 0 THEN 1990 + o_custkey % 30 END AS a, CASE WHEN o_custkey % 8 > 0 THEN 1990 + o_orderkey % 30 END AS b FROM orders)")
def plausible_years(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf, "orders").select("o_orderkey", identity.plausible_year(F.when(k % 9 > 0, c % 30 + 1990), F.when(c % 8 > 0, k % 30 + 1990), k % 2 == 0).alias("fine"))
