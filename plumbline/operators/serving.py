"""What is filled, gated and served from merged tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import text


def seed_wins(fresh: DataFrame, seed: DataFrame, twins: DataFrame) -> DataFrame:
    """Fresh events that are no seed event: not by id, nor as the same event (twins: id, seed_id); seed and fresh: id."""
    return fresh.join(seed.select("id"), "id", "left_anti").join(twins.select("id"), "id", "left_anti")


def agreed_facts(records: DataFrame, rows: DataFrame) -> DataFrame:
    """id, runtime, year: empty facts filled where the rows agree: runtimes within 3 minutes, one year; the most frequent value, then the least.

    records and rows: id, runtime, year.
    """
    def said(c: str, fits: Column) -> DataFrame:
        d = rows.filter(F.col(c).isNotNull()).groupBy("id", c).agg(F.count(F.lit(1)).alias("n"))
        g = d.groupBy("id").agg(F.min(c).alias("lo"), F.max(c).alias("hi"), F.min_by(c, F.struct((-F.col("n")).alias("m"), c)).alias("v"))
        return g.filter(fits).select("id", F.col("v").alias(f"new_{c}"))

    d = records.join(said("runtime", (F.col("hi") - F.col("lo") <= 3) & F.col("lo").between(20, 400)), "id", "left").join(said("year", (F.col("hi") == F.col("lo")) & F.col("lo").between(1890, 2100)), "id", "left")
    return d.select("id", F.coalesce("runtime", "new_runtime").alias("runtime"), F.coalesce("year", "new_year").alias("year"))


def mint_listed(rows: DataFrame, known: DataFrame, excluded: DataFrame, first: str, last: str) -> DataFrame:
    """theatre, key, display, page of a secondary listing's titles that match no show and aren't excluded.

    rows: theatre, title, date, time, page.  known, excluded: theatre, key.  The page is that of the first performance.
    """
    d = rows.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).filter(~F.rlike("title", F.lit(r"(?iu)\bгостува\s+в\b")))
    d = d.withColumn("key", text.show_key(F.col("title"))).filter("key <> ''").join(known, ["theatre", "key"], "left_anti").join(excluded, ["theatre", "key"], "left_anti")
    spelt = d.withColumn("shown", text.display_title(F.col("title")))
    n = spelt.groupBy("theatre", "key", "shown").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("date", "time", "page")).alias("at"))
    return n.groupBy("theatre", "key").agg(F.min_by("shown", F.struct(text.all_caps(F.col("shown")).cast("int").alias("c"), (-F.col("n")).alias("m"), "at", "shown")).alias("display"), F.min("at")["page"].alias("page"))


def retitled(minted: DataFrame, spellings: DataFrame) -> DataFrame:
    """id, old, new: minted shows whose theatre spells the same title better; tables: id, title."""
    m = minted.withColumn("key", text.show_key(F.col("title"))).filter("key <> ''")
    s = spellings.withColumn("key", text.show_key(F.col("title"))).select("id", "key", text.display_title(F.col("title")).alias("shown"), F.lit(0).alias("own"))
    d = m.select("id", "key").join(s, ["id", "key"]).unionByName(m.select("id", "key", text.display_title(F.col("title")).alias("shown"), F.lit(1).alias("own")))
    n = d.groupBy("id", "shown").agg(F.count(F.lit(1)).alias("n"), F.min("own").alias("own"))
    best = n.groupBy("id").agg(F.min_by("shown", F.struct(text.all_caps(F.col("shown")).cast("int").alias("c"), (-F.col("n")).alias("m"), "own", "shown")).alias("new"))
    return minted.select("id", F.col("title").alias("old")).join(best, "id").filter("new <> old and new <> ''")


def window_sanity(cells: DataFrame, first: str, last: str) -> DataFrame:
    """One row: rows before, inside and after the window, and whether the window itself is sane."""
    a, b = F.lit(first).cast("date"), F.lit(last).cast("date")
    return cells.agg(F.count_if(F.col("date") < a).alias("before"), F.count_if(F.col("date").between(a, b)).alias("inside"), F.count_if(F.col("date") > b).alias("after"), F.first(a <= b).alias("sane"))


def floors(counts: DataFrame, least: dict[str, int]) -> DataFrame:
    """name, n, floor of tables that collapsed; counts: name, n."""
    table = F.create_map(*[F.lit(x) for kv in least.items() for x in kv])
    return counts.withColumn("floor", F.element_at(table, F.col("name"))).filter(F.coalesce("n", F.lit(0)) < F.col("floor"))


def freshness(stamps: DataFrame, now: str, hours: int = 36) -> DataFrame:
    """id, verdict of stamps (id, generated as text, upcoming): missing, unreadable, old, empty or ok."""
    t = F.try_to_timestamp("generated")
    age = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(t)) / 3600
    return stamps.select("id", F.when(F.coalesce("generated", F.lit("")) == "", "missing").when(t.isNull(), "unreadable").when(age > hours, "old").when(F.col("upcoming") == 0, "empty").otherwise("ok").alias("verdict"))


def shape_problems(rows: DataFrame, key: str, rules: dict[str, str]) -> DataFrame:
    """key, problem of rows that break a rule (name: SQL test that must hold); every broken rule gives a row."""
    broken = F.array(*[F.when(~F.coalesce(F.expr(test), F.lit(False)), name) for name, test in rules.items()])
    return rows.select(key, F.explode(F.filter(broken, lambda x: x.isNotNull())).alias("problem"))


def lost_scores(old: DataFrame, new: DataFrame, sources: list[str], least: int = 3) -> DataFrame:
    """source, lost: of films listed in both runs and matched to the same title, how many had a score and have none; at least least."""
    d = old.alias("o").join(new.alias("n"), F.col("o.id") == F.col("n.id")).filter(F.col("o.match").eqNullSafe(F.col("n.match")))
    each = F.array(*[F.when(F.col(f"o.{s}").isNotNull() & F.col(f"n.{s}").isNull(), s) for s in sources])
    return d.select(F.explode(F.filter(each, lambda x: x.isNotNull())).alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("lost")).filter(F.col("lost") >= least)


def joined_times(pages: DataFrame) -> DataFrame:
    """key, date, times: the union of times that several pages give for a link, or where there is none a title."""
    k = F.coalesce(F.nullif(F.col("link"), F.lit("")), "title").alias("key")
    return pages.select(k, "date", "time").groupBy("key", "date").agg(F.array_join(F.array_sort(F.collect_set("time")), ",").alias("times"))


def synopsis_measure(shows: DataFrame, thin: int = 280) -> DataFrame:
    """theatre (null: all), n, none, thin, full by the length of a shown text."""
    size = F.length(F.trim(F.coalesce("text", F.lit(""))))
    return shows.rollup("theatre").agg(F.count(F.lit(1)).alias("n"), F.count_if(size == 0).alias("none"), F.count_if((size > 0) & (size < thin)).alias("thin"), F.count_if(size >= thin).alias("full"))


def ratable(films: DataFrame, flags: list[str]) -> DataFrame:
    """group, films, any, ratable: films of one outer match count once; ratable are those with a score or votes somewhere; films: group, id, match, votes and flags."""
    k = F.coalesce(F.concat(F.lit("m"), F.col("match").cast("string")), F.concat(F.lit("i"), F.col("id").cast("string")))
    one = films.groupBy("group", k.alias("k")).agg(F.max(F.greatest(*[F.coalesce(F.col(f).cast("int"), F.lit(0)) for f in flags])).alias("any"), F.max(F.coalesce("votes", F.lit(0))).alias("votes"))
    return one.groupBy("group").agg(F.count(F.lit(1)).alias("films"), F.sum("any").alias("any"), F.count_if((F.col("any") == 1) | (F.col("votes") > 0)).alias("ratable"))


def round_trip(rows: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(packed texts, rows read back from them): values joined by bars."""
    packed = rows.select(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("packed")).distinct()
    parts = F.split("packed", r"\|")
    return packed, packed.filter(F.size(parts) == len(columns)).select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)])


def fill_details(pages: DataFrame, records: DataFrame, info: DataFrame, outer: DataFrame, fields: list[str]) -> DataFrame:
    """id, fields, gained: a page's value only where the record, the stored info and the outer source have none; all: id and fields."""
    d = pages.alias("p").join(records.alias("r"), F.col("p.id") == F.col("r.id"), "left").join(info.alias("i"), F.col("p.id") == F.col("i.id"), "left").join(outer.alias("o"), F.col("p.id") == F.col("o.id"), "left")

    def has(x: str, c: str) -> Column:
        return F.coalesce(F.col(f"{x}.{c}").cast("string"), F.lit("")) != ""

    gained = {c: has("p", c) & ~has("i", c) & ~has("r", c) & ~has("o", c) for c in fields}
    out = [F.when(gained[c], F.col(f"p.{c}")).otherwise(F.col(f"i.{c}")).alias(c) for c in fields]
    return d.select(F.col("p.id").alias("id"), *out, F.array_join(F.filter(F.array(*[F.when(g, c) for c, g in gained.items()]), lambda x: x.isNotNull()), ",").alias("gained"))


def layered(ids: DataFrame, layers: list[DataFrame], fields: list[str]) -> DataFrame:
    """id and the first non-empty value of each field over layers (id, fields) in order of trust."""
    d = ids.select("id")
    for i, x in enumerate(layers):
        d = d.join(x.select("id", *[F.col(c).alias(f"{c}_{i}") for c in fields]), "id", "left")
    return d.select("id", *[F.coalesce(*[F.nullif(F.col(f"{c}_{i}"), F.lit("")) for i in range(len(layers))]).alias(c) for c in fields])


def confirm_sales(rows: DataFrame, selectors: DataFrame, cap: int) -> DataFrame:
    """slot, state: rows whose grid says sold out or box office only, checked on their selector page; the nearest cap are asked, the others keep their word; selectors: slot, online."""
    doubt = rows.filter("state <> 'online'").orderBy("date", "slot").limit(cap).select("slot")
    asked = doubt.join(selectors, "slot", "left").select("slot", F.coalesce("online", F.lit(False)).alias("online"), F.lit(True).alias("asked"))
    d = rows.join(asked, "slot", "left")
    return d.select("slot", F.when(F.coalesce("online", F.lit(False)), "online").otherwise(F.col("state")).alias("state"), F.coalesce("asked", F.lit(False)).alias("asked"))


def served(records: DataFrame) -> DataFrame:
    """What a page gets of a matched record: scores, year, and a trailer only of the same year and of a known kind; records: id, matched, year, outer_year, imdb, votes, trailer_key, trailer_lang, trailer_kind."""
    fits = (F.coalesce(F.abs(F.col("outer_year") - F.col("year")) <= 1, F.col("year").isNull())) & F.col("outer_year").isNotNull()
    good = F.rlike(F.coalesce("trailer_key", F.lit("")), F.lit("^[A-Za-z0-9_-]{11}$")) & F.col("trailer_lang").isin("bg", "en") & F.col("trailer_kind").isin("Trailer", "Teaser")
    return records.filter("matched").select("id", "imdb", text.compact_votes(F.col("votes")).alias("votes"), F.col("outer_year").alias("year"), F.when(fits & good, F.col("trailer_key")).alias("trailer"))


def probe_report(reads: DataFrame, marks: list[str]) -> DataFrame:
    """host, pages, bytes, and how many pages hold each mark; reads: url, html."""
    from plumbline.functions import urls

    return reads.groupBy(urls.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("html")).alias("chars"), *[F.count_if(F.contains("html", F.lit(m))).alias(f"mark_{i}") for i, m in enumerate(marks)])


def markdown(coverage: DataFrame, title: str) -> DataFrame:
    """position, line of a small report: one heading and a table row a kind; coverage: kind, n, covered."""
    rows = coverage.select((F.row_number().over(W.orderBy("kind")) + 3).cast("long").alias("position"), F.format_string("| %s | %d/%d | %d |", F.col("kind"), F.col("covered"), F.col("n"), F.col("n") - F.col("covered")).alias("line"))
    head = coverage.sparkSession.createDataFrame([(0, f"# {title}"), (1, ""), (2, "| kind | covered | missing |"), (3, "|---|---|---|")], "position long, line string")
    return head.unionByName(rows)


def page_rows(pages: DataFrame, column: str, item: str, fields: dict[str, str], keep: list[str]) -> DataFrame:
    """A row for each match of the item pattern in a page, with its fields' first groups (null where absent) and its place."""
    blocks = pages.select(*keep, F.posexplode(F.regexp_extract_all(column, F.lit(item), F.lit(0))).alias("place", "__block"))
    return blocks.select(*keep, "place", *[F.nullif(F.trim(F.regexp_extract("__block", p, 1)), F.lit("")).alias(c) for c, p in fields.items()])


def day_verdicts(pages: DataFrame) -> DataFrame:
    """id, verdict of a page asked for a day: unread, another day (it must echo the date), empty or ok; pages: id, asked, html (null: unread), slots."""
    echo = F.contains("html", F.date_format("asked", "yyyy-MM-dd")) | F.contains("html", F.date_format("asked", "dd.MM.yyyy"))
    return pages.select("id", F.when(F.col("html").isNull(), "unread").when(~echo, "another day").when(F.col("slots") == 0, "empty").otherwise("ok").alias("verdict"))


def sale_state(words: Column) -> Column:
    """What a badge says of a performance: box office, sold out, not yet, cancelled, online or unknown."""
    rules = [("cancelled", "отменен"), ("sold out", "разпродаден|няма свободни|sold\\s*out"), ("box office", "само на каса|на касата"), ("not yet", "очаквайте|скоро в продажба"), ("online", "купи|buy\\s*ticket")]
    out = F.lit("unknown")
    for name, p in reversed(rules):
        out = F.when(F.rlike(words, F.lit(f"(?iu){p}")), name).otherwise(out)
    return out


def touring(rows: DataFrame, own: str, city: str) -> DataFrame:
    """Rows with part: own (at home), city (elsewhere in the city) or touring, by the place each names."""
    place = F.lower(F.coalesce("place", F.lit("")))
    return rows.withColumn("part", F.when((place == "") | F.contains(place, F.lit(own)), "own").when(F.contains(place, F.lit(city)), "city").otherwise("touring"))


@F.pandas_udf(T.StringType())
def decoded(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Bytes as text: UTF-8 where they are valid, else Windows Cyrillic, which Spark's own decode doesn't know."""

    def one(b: bytes | None) -> str | None:
        if b is None:
            return None
        try:
            return b.decode("utf-8")
        except UnicodeDecodeError:
            return b.decode("cp1251", "replace")

    for p in pages:
        yield p.map(one)
