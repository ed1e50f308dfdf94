"""Records that are one film: evidence, pair rules with a conflict veto, components, survivors, redirects.

Pairs meet by equi joins only: at a shared key, at a shared outer id, at a key less
one short word, and at runs of whole words of the longer title.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import graph

# fixed values: words that make a longer title another film, and short words that don't
SEQUEL = (
    "ii", "iii", "iv", "vi", "vii", "viii", "ix", "іі", "ііі", "іv", "част", "part", "chapter", "глава", "епизод", "episode", "сезон", "season", "vol", "том", "завръщане",
    "завръщането", "returns", "reloaded", "продължение",
)
SHORT_WORDS = ("от", "на", "за", "в", "във", "и", "с", "със", "по", "до", "the", "of", "a", "an", "and", "to", "in", "on")
FUZZY = ("function-word", "prefix", "contained")
#: words of venues that are sent to every task at most
MOST_TRIED = 100_000
NEAR_YEARS, NEAR_RUNTIMES, SAME_RUNTIMES = 1, 10, 3


def screenings(slots: DataFrame) -> DataFrame:
    """id, at: a film's different slots (venue, date, time) in one row; slots of that form stay as they are."""
    if "at" in slots.columns:
        return slots
    # dealt by film first, so that nothing but arrays is left to merge
    return slots.select("id", F.struct("venue", "date", "time").alias("x")).repartition("id").groupBy("id").agg(F.collect_set("x").alias("at"))


def evidence(films: DataFrame, slots: DataFrame) -> DataFrame:
    """What is known about each film on screen.

    films: id, bg, en, original, years, runtimes, ids (arrays), minted.  slots: id, venue, date, time, or screenings of those.
    A title is cleaned once; bare, its key without the note, is for titles with a note only.
    """
    venues = F.filter(F.transform("at", lambda x: x["venue"]), lambda v: v.isNotNull())
    dates = F.transform("at", lambda x: x["date"])
    shown = screenings(slots).select("id", F.array_sort(F.array_distinct(venues)).alias("venues"), F.size("at").cast("long").alias("slots"), F.array_min(dates).alias("first"), F.array_max(dates).alias("last"))
    d = graph.spread(films.select("id", "bg", "en", "original", "years", "runtimes", "ids", "minted")).withColumn("clean", text.clean_title(F.col("bg")))
    d = text.with_keys(d, "clean", cleaned=True)
    for c in ("en", "original"):
        d = text.with_keys(d, c, f"key_{c}", "__unused")
    d = d.withColumn("note", text.note_of(F.col("clean"))).withColumn("less", F.when(F.col("note") != "", text.without_note(F.col("clean")))).withColumn("year", text.title_year(F.col("clean")))
    d = text.with_keys(d, "less", "bare", "__unused")
    years = F.array_sort(F.array_distinct(F.filter(F.concat("years", F.array("year")), lambda y: y.isNotNull())))
    own = F.filter(F.array("key", "key_en", "key_original"), lambda x: F.coalesce(x, F.lit("")) != "")
    d = graph.cut(d.select("id", "bg", "minted", "key", F.coalesce("base", "key").alias("main"), "note", "bare", years.alias("years"), "runtimes", "ids", own.alias("own")))
    keys = d.select("id", F.explode("own").alias("key")).groupBy("id").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    return d.drop("own").join(graph.large(keys), "id").join(graph.large(shown), "id")


def _near(a: Column, b: Column, most: int) -> Column:
    return F.exists(a, lambda x: F.exists(b, lambda y: F.abs(x - y) <= most))


def conflict(a: str, b: str) -> Column:
    """Years or runtimes that are known on both sides and don't meet."""
    def apart(c: str, most: int) -> Column:
        x, y = F.col(f"{a}.{c}"), F.col(f"{b}.{c}")
        return (F.size(x) > 0) & (F.size(y) > 0) & ~_near(x, y, most)

    return apart("years", NEAR_YEARS) | apart("runtimes", NEAR_RUNTIMES)


def _guard(short: Column, rest: Column, long: Column) -> Column:
    """The shorter key can stand for the longer: two words, eight letters, equal numbers, no sequel word beside it."""
    return (F.size(F.split(short, " ")) >= 2) & (text.letters(short) >= 8) & (text.digits(short) == text.digits(long)) & ~F.arrays_overlap(F.split(rest, " "), F.array(*map(F.lit, SEQUEL)))


def _runs(words: Column, first_only: bool) -> Column:
    """Runs of two words and more that don't reach the end (first_only), or don't begin at the start."""
    n = F.size(words)
    if first_only:
        return F.transform(F.sequence(F.lit(2), n - 1), lambda k: F.array_join(F.slice(words, F.lit(1), k), " "))
    starts = F.sequence(F.lit(2), n - 1)
    return F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(2), n - i + 1), lambda k: F.array_join(F.slice(words, i, k), " "))))


def multi_hall_venues(ev: DataFrame, slots: DataFrame, least: int = 2) -> DataFrame:
    """Venues that ran two films without a common title word at one time, at least times.

    Most slots show it by their first and last film alone, and a word that stands in all titles of a venue rules it out.  Only for
    the venues left the films of the other slots are brought together: a word in all titles settles a slot, the rest is looked at pair by pair.
    """
    at = screenings(slots).select("id", F.explode("at").alias("x"))
    words = graph.large(ev.select("id", F.array_distinct(F.split("key", " ")).alias("words")))
    ends = at.groupBy("x").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a <> b")
    for c in "ab":
        ends = ends.join(words.select(F.col("id").alias(c), F.col("words").alias(f"w{c}")), c, "left")
    ends = graph.cut(ends.select("x", F.col("x.venue").alias("venue"), F.coalesce(~F.arrays_overlap("wa", "wb"), F.lit(False)).alias("apart"), F.array_intersect("wa", "wb").alias("common")))

    def often(moments: DataFrame) -> DataFrame:
        return moments.groupBy("venue").agg(F.count(F.lit(1)).alias("moments")).filter(F.col("moments") >= least).select("venue")

    sure = graph.cut(often(ends.filter("apart")))
    rest = ends.join(sure, "venue", "left_anti")
    # a word of all titles is in those of any slot
    tried = graph.cut(rest.groupBy("venue").agg(F.bool_or("apart").alias("apart"), F.first("common").alias("common")).filter("not apart").select("venue", F.explode("common").alias("word")))
    shown = screenings(slots).select("id", F.explode(F.array_distinct(F.transform("at", lambda x: x["venue"]))).alias("venue")).join(words, "id")
    shown = shown.join(F.broadcast(tried) if tried.count() <= MOST_TRIED else graph.large(tried), "venue")
    alike = shown.groupBy("venue", "word").agg(F.bool_and(F.array_contains("words", F.col("word"))).alias("all")).filter("all").select("venue").distinct()
    rest = graph.cut(rest.join(graph.large(alike), "venue", "left_anti"))
    if rest.filter("not apart").isEmpty():
        return sure
    per = at.join(graph.large(rest.filter("not apart").select("x")), "x").join(words, "id").groupBy("x").agg(F.count(F.lit(1)).alias("films"), F.collect_set("words").alias("titles")).filter("films > 1")
    common = F.reduce("titles", F.get("titles", F.lit(0)), lambda w, t: F.array_intersect(w, t))
    apart = F.when(F.size(common) > 0, F.lit(False)).otherwise(F.exists("titles", lambda x: F.exists("titles", lambda y: ~F.arrays_overlap(x, y))))
    more = rest.filter("apart").select("venue").unionByName(per.filter(apart).select(F.col("x.venue").alias("venue")))
    return sure.unionByName(often(more)).distinct()


def lend_versions(ev: DataFrame, slots: DataFrame) -> DataFrame:
    """ev in which the listing of a language version lends its years, runtimes and ids to the one film it is a version of."""
    known = F.struct("id", "years", "runtimes", "ids", "venues", "first", "last")
    v = ev.filter("note <> '' and bare <> ''").select(known.alias("v"), F.col("bare").alias("main"))
    h = ev.filter("note = ''").select(known.alias("h"), "main")
    pairs = v.join(graph.large(h), "main").filter(~conflict("v", "h") & _guard(F.col("main"), F.lit(""), F.col("main")) & F.arrays_overlap("v.venues", "h.venues") & (F.col("v.first") <= F.col("h.last")) & (F.col("h.first") <= F.col("v.last")))
    one = pairs.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("v.id"))).filter("n = 1")
    more = one.groupBy(F.col("h.id").alias("id")).agg(*[F.flatten(F.collect_list(f"v.{c}")).alias(f"m_{c}") for c in ("years", "runtimes", "ids")])
    d = ev.join(more, "id", "left")
    for c in ("years", "runtimes", "ids"):
        d = d.withColumn(c, F.array_sort(F.array_union(c, F.coalesce(f"m_{c}", F.slice(F.col(c), 1, 0))))).drop(f"m_{c}")
    return d


def shared_screenings(slots: DataFrame, pairs: DataFrame, halls: DataFrame) -> DataFrame:
    """a, b of pairs that list the very same screening: one at a one-hall venue, else two or more that are all of one's there."""
    def known(c: str) -> Column:
        return F.filter(c, lambda x: x["venue"].isNotNull() & x["date"].isNotNull() & x["time"].isNotNull())

    def there(c: str, v: Column) -> Column:
        return F.size(F.filter(c, lambda x: x["venue"] == v))

    s, d = graph.large(screenings(slots)), pairs.select("a", "b").distinct()
    for x in "ab":
        d = d.join(s.select(F.col("id").alias(x), F.col("at").alias(f"at_{x}")), x)
    d = d.withColumn("both", F.array_intersect(known("at_a"), known("at_b")))
    each = F.transform(F.array_distinct(F.transform("both", lambda x: x["venue"])), lambda v: F.struct(v.alias("venue"), there("both", v).alias("n"), there("at_a", v).alias("na"), there("at_b", v).alias("nb")))
    per = d.select("a", "b", F.explode(each).alias("v")).select("a", "b", "v.*").join(halls.select("venue", F.lit(True).alias("halls")), "venue", "left")
    g = per.groupBy("a", "b").agg(F.bool_or(F.col("halls").isNull()).alias("lone"), F.sum("n").alias("n"), F.bool_and(F.col("n") == F.col("na")).alias("all_a"), F.bool_and(F.col("n") == F.col("nb")).alias("all_b"))
    return g.filter(F.col("lone") | ((F.col("n") >= 2) & (F.col("all_a") | F.col("all_b")))).select("a", "b")


def edges(ev: DataFrame, slots: DataFrame, halls: DataFrame, distinct: DataFrame) -> DataFrame:
    """a < b, rule: pairs that are one film by the first rule that holds; distinct: a, b that a person told apart."""
    rec = graph.large(ev.select("id", F.struct("note", "minted", "years", "runtimes", "venues", "first", "last").alias("r")))

    def paired(d: DataFrame, rule: int) -> DataFrame:
        return d.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.lit(rule).alias("rule"), F.col("x").alias("short")).filter("a <> b")

    k = graph.large(ev.select("id", F.explode("keys").alias("key")))
    same_key = k.select(F.col("id").alias("x"), "key").join(k.select(F.col("id").alias("y"), "key"), "key").filter("x < y")
    i = ev.select("id", F.explode("ids").alias("outer"))
    same_id = i.select(F.col("id").alias("x"), "outer").join(i.select(F.col("id").alias("y"), "outer"), "outer").filter("x < y")
    words = k.withColumn("w", F.split("key", " "))
    less = words.filter(F.size("w") >= 4).select(F.col("id").alias("y"), F.col("key").alias("long"), F.posexplode("w").alias("at", "word"), "w").filter(F.col("word").isin(*SHORT_WORDS))
    less = less.withColumn("key", F.array_join(F.filter("w", lambda x, n: n != F.col("at")), " "))
    dropped = less.join(k.select(F.col("id").alias("x"), "key"), "key").filter(text.digits(F.col("key")) == text.digits(F.col("long"))).select("x", "y").distinct()
    longer = ev.select("id", F.explode(F.array_distinct(F.concat("keys", F.array("main")))).alias("long")).withColumn("w", F.split("long", " "))
    begins = longer.filter(F.size("w") >= 3).select(F.col("id").alias("y"), "long", F.explode(_runs(F.col("w"), True)).alias("key"))
    begins = begins.join(k.select(F.col("id").alias("x"), "key"), "key").filter(_guard(F.col("key"), F.expr("substring(long, length(key) + 2)"), F.col("long"))).select("x", "y").distinct()
    mains = ev.select(F.col("id").alias("y"), F.col("main").alias("long")).withColumn("w", F.split("long", " ")).filter(F.size("w") >= 3)
    inside = mains.select("y", "long", F.explode(F.array_distinct(_runs(F.col("w"), False))).alias("key"))
    inside = inside.join(graph.large(ev.select(F.col("id").alias("x"), "key")), "key").filter(~F.startswith("long", F.concat("key", F.lit(" "))) & (text.letters(F.col("key")) >= 10))
    rest = F.expr("trim(replace(concat(' ', long, ' '), concat(' ', key, ' '), ' '))")
    inside = inside.filter(_guard(F.col("key"), rest, F.col("long"))).select("x", "y").distinct()
    found = paired(same_key, 1).unionByName(paired(same_id, 2)).unionByName(paired(dropped, 3)).unionByName(paired(begins, 4)).unionByName(paired(inside, 5)).distinct()
    found = graph.cut(found.join(distinct.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
    d = found.join(rec.select(F.col("id").alias("a"), F.col("r").alias("p")), "a").join(rec.select(F.col("id").alias("b"), F.col("r").alias("q")), "b")
    d = graph.cut(d.filter((F.col("p.note") == F.col("q.note")) & (F.col("p.minted") | F.col("q.minted")) & ~conflict("p", "q")))
    screened = shared_screenings(slots, d.filter("rule = 4"), halls).withColumn("screened", F.lit(True))
    d = d.join(screened, ["a", "b"], "left")
    overlap = (F.col("p.first") <= F.col("q.last")) & (F.col("q.first") <= F.col("p.last"))
    apart = ~F.arrays_overlap("p.venues", "q.venues")
    both = _near(F.col("p.runtimes"), F.col("q.runtimes"), SAME_RUNTIMES) & F.arrays_overlap("p.years", "q.years")
    holds = (F.col("rule") <= 2) | (overlap & F.when(F.col("rule") == 3, apart).when(F.col("rule") == 4, F.coalesce("screened", F.lit(False)) | both).otherwise(both & apart))
    first = d.filter(holds).groupBy("a", "b").agg(F.min("rule").alias("rule"))
    names = F.array(*map(F.lit, ("same-key", "same-id", *FUZZY)))
    return first.select("a", "b", F.get(names, F.col("rule") - 1).alias("rule"))


def unshared(found: DataFrame, ev: DataFrame) -> DataFrame:
    """Edges without the fuzzy ones of a shorter title that fits two different films."""
    n = graph.large(ev.select("id", F.length("key").alias("n")))
    d = found.join(n.select(F.col("id").alias("a"), F.col("n").alias("la")), "a").join(n.select(F.col("id").alias("b"), F.col("n").alias("lb")), "b")
    fuzzy = F.col("rule").isin(*FUZZY)
    short = F.when(F.col("la") <= F.col("lb"), F.col("a")).otherwise(F.col("b"))
    many = d.filter(fuzzy).groupBy(short.alias("id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
    for x in "ab":
        d = d.join(many.select(F.col("id").alias(x), F.lit(True).alias(f"m{x}")), x, "left")
    return d.filter(~(fuzzy & (F.coalesce("ma", F.lit(False)) | F.coalesce("mb", F.lit(False))))).select("a", "b", "rule")


def merges(found: DataFrame, ev: DataFrame) -> DataFrame:
    """drop, into: the records that go, of components without a conflict and with one catalogue film at most."""
    m = graph.cut(graph.components(found).withColumnRenamed("node", "id").join(graph.large(ev), "id"))
    seeds = m.groupBy("root").agg(F.count_if(~F.col("minted")).alias("seeds")).filter("seeds <= 1").select("root")
    # few different facts, however many records a component has
    facts = m.select("root", "years", "runtimes").distinct().withColumn("f", F.struct("years", "runtimes"))
    p, q = facts.select("root", F.col("f").alias("p")), facts.select("root", F.col("f").alias("q"))
    torn = p.join(q, "root").filter(conflict("p", "q")).select("root").distinct()
    m = m.join(seeds, "root").join(torn, "root", "left_anti")
    bare = text.strip_festival(F.col("bg")) == text.one_space(F.col("bg"))
    prefixed = F.when(bare, F.lit(False)).otherwise(text.clean_title(F.col("bg")) != text.clean_title(F.col("bg"), keep_prefix=True))
    order = F.struct(F.col("minted"), prefixed.alias("p"), (-F.size("venues")).alias("v"), (-F.col("slots")).alias("s"), (-((F.size("years") > 0).cast("int") + (F.size("runtimes") > 0).cast("int"))).alias("f"), (-F.length("bg")).alias("l"), "id")
    best = m.groupBy("root").agg(F.min_by("id", order).alias("into"))
    return m.join(best, "root").filter("id <> into").select(F.col("id").alias("drop"), "into")


def detect(films: DataFrame, slots: DataFrame, distinct: DataFrame) -> DataFrame:
    slots = graph.cut(screenings(slots))
    ev = graph.cut(lend_versions(graph.cut(evidence(films, slots)), slots))
    return merges(graph.cut(unshared(edges(ev, slots, multi_hall_venues(ev, slots), distinct), ev)), ev)


def remap_cells(cells: DataFrame, moves: DataFrame) -> DataFrame:
    """id, venue, date, times (array): ids by moves (old, final), cells that meet joined."""
    d = cells.join(moves.select(F.col("old").alias("id"), "final"), "id", "left").withColumn("id", F.coalesce("final", "id"))
    return d.groupBy("id", "venue", "date").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("times")))).alias("times"))


def remap_links(links: DataFrame, moves: DataFrame, order: str) -> DataFrame:
    """id, venue, url by moves; the kept film's own link wins, else the first by order."""
    d = links.join(moves.select(F.col("old").alias("id"), "final"), "id", "left")
    d = d.withColumn("moved", F.col("final").isNotNull()).withColumn("id", F.coalesce("final", "id"))
    return d.groupBy("id", "venue").agg(F.min_by("url", F.struct("moved", order)).alias("url"))


def undo(moves: DataFrame, distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(moves kept, moves taken back): drop, into, final against pairs a person told apart."""
    d = distinct.select("a", "b").unionByName(distinct.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    hit = moves.join(d, (F.col("drop") == F.col("a")) & ((F.col("b") == F.col("into")) | (F.col("b") == F.col("final"))), "left_semi")
    return moves.join(hit.select("drop"), "drop", "left_anti"), hit
