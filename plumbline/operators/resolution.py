"""Titles to catalogue entries by a cascade of rules, and titles that no rule places.

films: id, bg, en, original, year, runtime, minted.  titles: title_id, title, venue,
year, runtime, original.  aliases: grp, title, film (may be null), venues (empty: all).
moves: old, final, closed.  corroborated: title_id, id.  Every rule gives candidates by
an equi join; vetoes and choices are aggregates over them, so nothing is
looked up row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators.graph import cut, large, spread
from plumbline.operators.identity import one_edit

ALIAS, EXACT, ORIGINAL, TRANSLIT, SUBTITLE, SPELLING = range(1, 7)
NAMES = {ALIAS: "alias", EXACT: "exact", ORIGINAL: "original", TRANSLIT: "translit", SUBTITLE: "subtitle", SPELLING: "spelling"}
#: minutes that runtimes may differ by rule
SLACK = {SUBTITLE: 10, SPELLING: 20}
#: candidates go by rule times this plus the number of the alias group
GROUPS = 1_000_000


@dataclass
class Resolved:
    placed: DataFrame
    suspects: DataFrame


def film_index(films: DataFrame) -> DataFrame:
    """id, key, tkey, cyrillic, base: a row for each title of a film that has a key."""
    d = films.select("id", F.explode(F.array_distinct(F.filter(F.array("bg", "en", "original"), lambda t: F.coalesce(t, F.lit("")) != ""))).alias("t"))
    d = text.with_keys(d, "t").select("id", "key", "base").filter("key <> ''").distinct()
    return d.select("id", "key", "base", text.translit(F.col("key")).alias("tkey"), text.has_cyrillic(F.col("key")).alias("cyrillic"))


def film_facts(films: DataFrame) -> DataFrame:
    """id, fy, fr, bg, minted; the year may stand in the title."""
    year = F.coalesce(F.col("year").cast("int"), text.title_year(text.clean_title(F.coalesce("bg", F.lit("")))))
    return films.select("id", year.alias("fy"), F.col("runtime").cast("int").alias("fr"), "bg", "minted")


def _title_keys(titles: DataFrame) -> DataFrame:
    titles = spread(titles.select("title_id", "title", "venue", "year", "runtime", "original"))
    year = F.coalesce(F.col("year").cast("int"), text.title_year(text.clean_title(F.col("title"))))
    t = titles.select("title_id", "title", "venue", year.alias("ty"), F.col("runtime").cast("int").alias("tr"), F.coalesce("original", F.lit("")).alias("o"))
    return text.with_keys(text.with_keys(t, "o", "okey", "obase"), "title").drop("o", "obase").filter("key <> ''")


def alias_candidates(t: DataFrame, index: DataFrame, aliases: DataFrame, films: DataFrame) -> DataFrame:
    """title_id, id, grp: the film a group names, else every film with one of the group's keys."""
    a = text.with_keys(spread(aliases), "title").select("grp", "key", "film", "venues").filter("key <> ''").distinct()
    hit = t.join(large(a), "key").filter((F.size("venues") == 0) | F.array_contains("venues", F.col("venue"))).select("title_id", "grp", "film").distinct()
    hit = hit.join(large(films.select(F.col("id").alias("film"), F.lit(True).alias("known"))), "film", "left")
    named = hit.filter("known").select("title_id", F.col("film").alias("id"), "grp")
    open_ = hit.filter("known is null").select("title_id", "grp").join(large(a.select("grp", "key").distinct()), "grp").join(index.select("id", "key"), "key")
    return named.unionByName(open_.select("title_id", "id", "grp")).distinct()


def candidates(t: DataFrame, index: DataFrame, films: DataFrame, aliases: DataFrame, fuzzy: bool = True, last: int = SPELLING) -> DataFrame:
    """title_id, id, rule, grp: all candidates of all rules, before any veto; t: titles with their keys.

    Rules after last are left out, but for those that the number of an alias group reaches.  Each rule is
    written on its own, so that the driver never has the stages of all of them at once.
    """
    def by(d: DataFrame, rule: int) -> DataFrame:
        return cut(d.select("title_id", "id", F.lit(rule).alias("rule"), F.lit(0).alias("grp")).distinct())

    out = cut(alias_candidates(t, index, aliases, films).select("title_id", "id", F.lit(ALIAS).alias("rule"), F.col("grp").cast("int").alias("grp")))
    last = max(last, ALIAS + (out.agg(F.max("grp")).first()[0] or 0) // GROUPS)
    if last >= EXACT:
        out = out.unionByName(by(t.join(index, "key"), EXACT))
    if last >= ORIGINAL:
        out = out.unionByName(by(t.filter("okey <> ''").select("title_id", F.col("okey").alias("key")).join(index, "key"), ORIGINAL))
    if last >= TRANSLIT:
        cross = t.filter(text.letters(F.col("key")) >= 3).select("title_id", text.translit(F.col("key")).alias("tkey"), text.has_cyrillic(F.col("key")).alias("own"))
        out = out.unionByName(by(cross.join(index.filter(text.letters(F.col("key")) >= 3), "tkey").filter("own <> cyrillic"), TRANSLIT))
    if fuzzy and last >= SUBTITLE:
        longer = t.select("title_id", "key").join(index.filter("base is not null").select("id", F.col("base").alias("key")), "key")
        shorter = t.filter("base is not null").select("title_id", F.col("base").alias("key")).join(index.select("id", "key"), "key")
        out = out.unionByName(by(longer.select("title_id", "id").unionByName(shorter.select("title_id", "id")), SUBTITLE))
    if fuzzy and last >= SPELLING:
        out = out.unionByName(by(one_edit(t.select("title_id", "key"), index.select("id", "key").distinct(), "title_id", "id"), SPELLING))
    return out


def _gap(a: str, b: str) -> Column:
    return F.abs(F.col(a) - F.col(b))


def veto_reason(rule: Column) -> Column:
    """Why a candidate can't be the title's film: year or runtime of it or of what it was merged into; an unknown fact never vetoes."""
    year = F.coalesce(F.greatest(_gap("ty", "fy"), _gap("ty", "cy")) > 1, F.lit(False))
    slack = F.when(rule == SUBTITLE, SLACK[SUBTITLE]).when(rule == SPELLING, SLACK[SPELLING])
    runtime = F.coalesce(F.greatest(_gap("tr", "fr"), _gap("tr", "cr")) > slack, F.lit(False))
    return F.when(year, "year").when(runtime, "runtime")


def resolve(titles: DataFrame, films: DataFrame, aliases: DataFrame, moves: DataFrame, corroborated: DataFrame, fuzzy: bool = True, last: int = SPELLING) -> Resolved:
    """placed: title_id, rule, id (null if nothing decides), why; suspects: title_id, id, rule, reason.

    The first rule with candidates answers.  Among several: a lone catalogue film, one
    of the title's year, one of exactly this title; else ambiguous, and placed nowhere.
    last: placings by later rules aren't wanted, and no candidate that only they have is looked for.
    """
    # read by every rule: written once
    films = cut(spread(films.select("id", "bg", "en", "original", "year", "runtime", "minted")))
    facts, t, index = large(cut(film_facts(films))), large(cut(_title_keys(titles))), large(cut(film_index(films)))
    c = candidates(t, index, films.select("id"), aliases, fuzzy, last).join(facts.select("id", "fy", "fr"), "id")
    c = c.join(large(moves.select(F.col("old").alias("id"), "final")), "id", "left").withColumn("canon", F.coalesce("final", "id"))
    c = c.join(facts.select(F.col("id").alias("canon"), F.col("fy").alias("cy"), F.col("fr").alias("cr"), F.col("bg").alias("cbg"), F.col("minted").alias("cminted")), "canon")
    c = c.join(t.select("title_id", "title", "ty", "tr", "key"), "title_id").withColumn("veto", veto_reason(F.col("rule")))
    # a film merged away is no catalogue film
    minted = F.col("cminted")
    c = c.join(large(corroborated.select("title_id", F.col("id").alias("canon"), F.lit(True).alias("listed")).distinct()), ["title_id", "canon"], "left")
    same_year = F.coalesce(F.col("ty") == F.col("cy"), F.lit(False)) & F.coalesce(_gap("tr", "cr") <= SLACK[SUBTITLE], F.lit(True))
    same_time = F.coalesce(_gap("tr", "cr") <= 3, F.lit(False)) & ~F.coalesce(F.col("ty") != F.col("cy"), F.lit(False))
    proved = (F.col("rule") != SUBTITLE) | F.coalesce("listed", F.lit(False)) | same_year | same_time
    reason = F.when(F.col("veto").isNotNull(), F.concat(F.col("veto"), F.lit(" veto"))).when(~proved, "not corroborated")
    c = cut(c.withColumn("reason", reason))
    suspects = c.filter("reason is not null").select("title_id", "id", F.col("rule"), "reason").distinct()
    kept = c.filter("reason is null").select("title_id", "rule", "grp", "title", "ty", "key", F.col("canon").alias("id"), "cy", "cbg", minted.alias("minted")).distinct()
    order = F.col("rule") * GROUPS + F.col("grp")
    kept = kept.withColumn("first", F.min(order).over(W.partitionBy("title_id"))).filter(order == F.col("first"))
    # of corroborated subtitle variants the first by id stands
    kept = kept.withColumn("least", F.min("id").over(W.partitionBy("title_id"))).filter((F.col("rule") != SUBTITLE) | (F.col("id") == F.col("least")))
    placed = choose(kept)
    own = index.select("id", "key", F.lit(True).alias("own")).distinct()
    placed = placed.join(t.select("title_id", "key"), "title_id").join(own, ["id", "key"], "left")
    rule = F.when((F.col("rule") == ALIAS) & F.col("own"), EXACT).otherwise(F.col("rule"))
    return Resolved(placed.select("title_id", rule.alias("rule"), "id", "why"), suspects)


def choose(kept: DataFrame) -> DataFrame:
    """title_id, rule, id, why of candidates title_id, rule, id, title, ty, cy, cbg, minted of one rule a title."""
    seed = ~F.col("minted")
    w = W.partitionBy("title_id")
    d = kept.withColumn("seeds", F.count_if(seed).over(w)).withColumn("pool", (F.col("seeds") == 0) | seed)
    year = F.col("pool") & F.coalesce(F.col("ty") == F.col("cy"), F.lit(False))
    same = F.col("pool") & F.coalesce(F.lower("cbg") == F.lower("title"), F.lit(False))
    g = d.groupBy("title_id", "rule").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("lone"), F.max("seeds").alias("seeds"), F.min(F.when(seed, F.col("id"))).alias("seed"),
        F.count_if(year).alias("years"), F.min(F.when(year, F.col("id"))).alias("of_year"), F.count_if(same).alias("alike"), F.min(F.when(same, F.col("id"))).alias("of_title"),
    )
    by = [(F.col("n") == 1, "lone", "single"), (F.col("seeds") == 1, "seed", "catalogue"), (F.col("years") == 1, "of_year", "year"), (F.col("alike") == 1, "of_title", "title")]
    pick, why = F.lit(None).cast("long"), F.lit("ambiguous")
    for test, value, name in reversed(by):
        pick, why = F.when(test, F.col(value)).otherwise(pick), F.when(test, name).otherwise(why)
    return g.select("title_id", "rule", pick.alias("id"), why.alias("why"))


def held_titles(titles: DataFrame, placed: DataFrame, slots: DataFrame) -> DataFrame:
    """A row a key among ambiguous titles: spellings, venues and number of slots held back."""
    d = text.with_keys(titles.join(placed.filter("why = 'ambiguous'").select("title_id"), "title_id"), "title")
    n = slots.groupBy("title_id").agg(F.count(F.lit(1)).alias("n"))
    d = d.join(n, "title_id", "left")
    return d.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("title")), " / ").alias("titles"), F.array_join(F.array_sort(F.collect_set(F.col("venue").cast("string"))), ",").alias("venues"), F.sum(F.coalesce("n", F.lit(0))).alias("slots"))


def display_choice(rows: DataFrame, group: str, title: str, position: str) -> DataFrame:
    """The spelling of each group to print: not all capitals, then the most frequent, then the first."""
    d = rows.groupBy(group, title).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("at"))
    best = F.min_by(title, F.struct(text.all_caps(F.col(title)).cast("int"), (-F.col("n")).alias("m"), "at"))
    return d.groupBy(group).agg(best.alias("display"))


def minted(titles: DataFrame, taken: DataFrame, prefix: str = "film") -> DataFrame:
    """A record for each new title: id, bg, and what the source printed, if plausible.

    titles: title, year, runtime.  Ids are slugs; equal ones, and ones that are taken, get a number.
    """
    d = titles.withColumn("base", text.safe_id(F.col("title"), prefix))
    used = taken.select(F.regexp_replace("id", r"-\d+$", "").alias("base"), F.coalesce(F.regexp_extract("id", r"-(\d+)$", 1).try_cast("int"), F.lit(1)).alias("n")).groupBy("base").agg(F.max("n").alias("used"))
    return numbered(d, used)


def numbered(d: DataFrame, used: DataFrame) -> DataFrame:
    """Records of titles with a base id; used: base and the highest number taken."""
    d = d.join(used, "base", "left").withColumn("k", F.row_number().over(W.partitionBy("base").orderBy("title", "year", "runtime")) + F.coalesce("used", F.lit(0)))
    number = F.when(F.col("k") > 1, F.concat(F.lit("-"), F.col("k").cast("string"))).otherwise("")
    fits = [F.when(F.col(c).between(lo, hi), F.col(c)).alias(c) for c, lo, hi in (("year", 1890, 2100), ("runtime", 20, 400))]
    return d.select(F.concat("base", number).alias("id"), F.col("title").alias("bg"), *fits)


def mint_round(pending: DataFrame) -> DataFrame:
    """One record for all pending titles of one key: key, display, slots; pending: title, venue, position, slots.

    The keys are minted at once.  Only keys that a fuzzy rule links to each other need another round, over those alone.
    """
    d = text.with_keys(pending, "title").filter("key <> ''")
    shown = display_choice(d, "key", "title", "position")
    return d.groupBy("key").agg(F.sum("slots").alias("slots"), F.count(F.lit(1)).alias("titles")).join(shown, "key").withColumn("display", text.clean_title(F.col("display"), keep_prefix=True))


def mint_to_fixpoint(pending: DataFrame) -> DataFrame:
    """title_id, key: the minted key each pending title ends at, most slots first, ties to the larger key.

    A key joins one that is minted before it and that is one edit or a subtitle
    away; keys that nothing links are minted at once, so only the linked residue
    takes rounds, and each round settles every key without an unsettled better neighbour.
    """
    d = cut(text.with_keys(pending, "title").filter("key <> ''"))
    k = d.groupBy("key").agg(F.sum("slots").alias("slots"), F.min("base").alias("base")).withColumn("rank", F.struct("slots", "key"))
    near = one_edit(k.select(F.col("key").alias("id"), "key"), k.select(F.col("key").alias("other"), "key"), "id", "other")
    sub = k.filter("base is not null").select(F.col("key").alias("id"), F.col("base").alias("key")).join(k.select("key"), "key").select("id", F.col("key").alias("other"))
    links = near.unionByName(sub).unionByName(sub.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct()
    links = links.join(k.select(F.col("key").alias("id"), F.col("rank").alias("ri")), "id").join(k.select(F.col("key").alias("other"), F.col("rank").alias("ro")), "other").filter("ro > ri").select("id", "other", "ro")
    links = cut(links)
    state = cut(k.select("key", F.lit(None).cast("string").alias("into")))
    while True:
        better = links.join(state.select(F.col("key").alias("other"), "into"), "other")
        # settled neighbours that are minted themselves attract; an unsettled one makes the key wait
        seen = better.groupBy(F.col("id").alias("key")).agg(F.bool_or(F.col("into").isNull()).alias("waits"), F.max(F.when(F.col("into") == F.col("other"), F.struct("ro", "other"))).alias("best"))
        nxt = state.join(seen, "key", "left")
        ready = F.col("into").isNull() & ~F.coalesce("waits", F.lit(False))
        state = cut(nxt.select("key", F.when(ready, F.coalesce(F.col("best.other"), F.col("key"))).otherwise(F.col("into")).alias("into")))
        if state.filter("into is null").isEmpty():
            return d.join(state, "key").select("title_id", F.col("into").alias("key"))


def festival_slot_rule(unplaced: DataFrame, own: DataFrame, films: DataFrame) -> DataFrame:
    """title_id, id: the one film a venue's own programme lists in a slot of the title whose title differs by added words only.

    unplaced: title_id, title, year, venue, date, time.  own: venue, date, time, id.
    """
    def heads(k: Column) -> Column:
        w = F.split(k, " ")
        return F.filter(F.transform(F.sequence(F.lit(1), F.size(w)), lambda i: F.array_join(F.slice(w, F.lit(1), i), " ")), lambda h: h != k)

    def marks(*kinds: Column) -> Column:
        def named(n: str, k: Column) -> Column:
            return F.transform(k, lambda x: F.concat(F.lit(n), x))

        return F.explode(F.flatten(F.array(*[named(n, k) for n, k in zip("=<>~", kinds, strict=True)]))).alias("mark")

    # slots of a title and a film meet only where their keys are equal, one begins the other, or both sound alike
    slot = ["venue", "date", "time"]
    k, one = F.col("key"), F.array("key")
    f = film_index(films).select("id", marks(one, one, heads(k), F.array("tkey"))).distinct().join(film_facts(films).select("id", "fy"), "id")
    t = text.with_keys(unplaced.select("title_id", "title", "year").distinct(), "title").filter("key <> ''")
    t = t.select("title_id", "year", marks(one, heads(k), one, F.array(text.translit(k))))
    d = unplaced.select("title_id", *slot).distinct().join(t, "title_id").join(own.select("id", *slot).distinct().join(f, "id"), [*slot, "mark"])
    fits = d.filter(~F.coalesce(F.abs(F.col("year") - F.col("fy")) > 1, F.lit(False))).select("title_id", "id").distinct()
    return fits.groupBy("title_id").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).filter("n = 1").select("title_id", "id")


def place_kept(unplaced: DataFrame, independent: list, link: str = "link") -> DataFrame:
    """Titles that a merge left over and no rule placed: minted at an independent venue that links them, else unplaced."""
    ok = F.col("venue").isin(*independent) & (F.coalesce(F.col(link), F.lit("")) != "")
    return unplaced.select("title_id", "venue", F.when(F.col("why") == "ambiguous", "held").when(ok, "minted").otherwise("unplaced").alias("outcome"))


def scoped_resolution(titles: DataFrame, shows: DataFrame, aliases: DataFrame, moves: DataFrame) -> DataFrame:
    """title_id, id, rule within one theatre: an alias, an exact key, or of several records the one with most data.

    titles: title_id, theatre, title.  shows: id, theatre, title, title_en, minted, richness.  aliases: theatre, title, show.  moves: old, final.
    """
    def keyed(d: DataFrame, *cols: str) -> DataFrame:
        both = F.array_distinct(F.flatten(F.array(*[F.array(text.show_key(F.coalesce(F.col(c), F.lit(""))), text.show_key(F.coalesce(F.col(c), F.lit("")), False)) for c in cols])))
        return d.withColumn("k", F.explode(F.filter(both, lambda x: x != "")))

    t = keyed(titles, "title").select("title_id", "theatre", "k")
    a = keyed(aliases, "title").select("theatre", "k", F.col("show").alias("id"), F.lit(0).alias("rule"))
    s = keyed(shows, "title", "title_en").select("theatre", "k", "id", F.lit(1).alias("rule"))
    d = t.join(a.unionByName(s), ["theatre", "k"]).join(moves.select(F.col("old").alias("id"), "final"), "id", "left").withColumn("id", F.coalesce("final", "id"))
    d = d.select("title_id", "theatre", "id", "rule").distinct().join(shows.select("id", "theatre", "minted", "richness"), ["id", "theatre"])
    first = d.withColumn("best", F.min("rule").over(W.partitionBy("title_id"))).filter("rule = best")
    order = F.struct(F.col("minted"), (-F.col("richness")).alias("r"), "id")
    g = first.groupBy("title_id", "rule").agg(F.count_distinct("id").alias("n"), F.min_by("id", order).alias("id"))
    return g.select("title_id", "id", F.when(F.col("rule") == 0, "alias").when(F.col("n") > 1, "duplicate").otherwise("exact").alias("rule"))
