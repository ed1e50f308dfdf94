"""Which catalogue entry a published title means, without guessing at ties."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import text
from plumbline.operators import graph
from plumbline.operators.graph import spread

RULES = ("exact", "subtitle", "spelling")


def one_edit(a: DataFrame, b: DataFrame, left: str, right: str, key: str = "key", least: int = 8) -> DataFrame:
    """Pairs (left, right) whose keys are one edit apart, with as many words and the same digits.

    Different keys meet at hashes of their deletion variants, once however many rows have them, so no two keys
    are compared that don't share one; the distance is then measured, so a collision makes no pair.
    """

    def variants(d: DataFrame, k: str) -> DataFrame:
        d = spread(d.filter(text.letters(F.col(key)) >= least).select(F.col(key).alias(k)).distinct())
        d = d.withColumn("kind", F.xxhash64(F.size(F.split(k, " ")), text.digits(F.col(k))))
        gone = F.transform(F.sequence(F.lit(1), F.length(k)), lambda i: F.xxhash64("kind", F.concat(F.substring(F.col(k), F.lit(1), i - 1), F.substring(F.col(k), i + 1, F.length(k)))))
        return d.select(k, F.explode(F.array_distinct(F.concat(F.array(F.xxhash64("kind", k)), gone))).alias("variant"))

    same = (F.size(F.split("ka", " ")) == F.size(F.split("kb", " "))) & (text.digits(F.col("ka")) == text.digits(F.col("kb")))
    # one comparison: equal words and digits on their own would become join keys, matched again in every step of the sort
    near = F.levenshtein("ka", "kb", 1) == F.when(same, 1).otherwise(-2)
    d = variants(a, "ka").join(variants(b, "kb"), "variant").filter((F.col("ka") != F.col("kb")) & near).select("ka", "kb").distinct()
    return d.join(a.select(left, F.col(key).alias("ka")), "ka").join(b.select(right, F.col(key).alias("kb")), "kb").select(left, right).distinct()


def candidates(titles: DataFrame, catalogue: DataFrame) -> DataFrame:
    """title_id, id, rule: catalogue entries that fit a title by any rule and whose year doesn't veto.

    titles: title_id, title, year.  catalogue: id, title, year, minted.  An unknown year never vetoes.
    """
    t = text.with_keys(titles, "title").select("title_id", "key", "base", F.col("year").alias("ty"))
    c = text.with_keys(catalogue, "title").select("id", "key", "base")
    exact = t.join(c, "key").select("title_id", "id", F.lit(1).alias("rule"))
    sub = t.select("title_id", F.col("base").alias("key")).join(c.select("id", "key"), "key").unionByName(t.select("title_id", "key").join(c.select("id", F.col("base").alias("key")), "key"))
    spelt = one_edit(t.select("title_id", "key"), c.select("id", "key"), "title_id", "id").withColumn("rule", F.lit(3))
    found = exact.unionByName(sub.select("title_id", "id", F.lit(2).alias("rule"))).unionByName(spelt).distinct()
    found = found.join(titles.select("title_id", F.col("year").alias("ty")), "title_id").join(catalogue.select("id", F.col("year").alias("cy"), "minted"), "id")
    veto = F.coalesce(F.abs(F.col("ty") - F.col("cy")) > 1, F.lit(False))
    return found.filter(~veto)


def choose(found: DataFrame) -> DataFrame:
    """title_id, rule, id, why: of the first rule's candidates the only one, the only catalogue entry, the only one of the year; else null, ambiguous."""
    first = found.withColumn("first", F.min("rule").over(W.partitionBy("title_id"))).filter("rule = first")
    seed = ~F.col("minted")
    d = first.groupBy("title_id", "rule").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("lone"), F.count_if(seed).alias("seeds"), F.min(F.when(seed, F.col("id"))).alias("seed"),
        F.count_if(seed & F.coalesce(F.col("ty") == F.col("cy"), F.lit(False))).alias("seed_years"), F.min(F.when(seed & (F.col("ty") == F.col("cy")), F.col("id"))).alias("seed_year"),
        F.count_if(F.coalesce(F.col("ty") == F.col("cy"), F.lit(False))).alias("years"), F.min(F.when(F.col("ty") == F.col("cy"), F.col("id"))).alias("of_year"),
    )
    pool_years, pool_year = F.when(F.col("seeds") > 0, F.col("seed_years")).otherwise(F.col("years")), F.when(F.col("seeds") > 0, F.col("seed_year")).otherwise(F.col("of_year"))
    by = [(F.col("n") == 1, F.col("lone"), "single"), (F.col("seeds") == 1, F.col("seed"), "catalogue"), (pool_years == 1, pool_year, "year")]
    pick, why = F.lit(None).cast("long"), F.lit("ambiguous")
    for test, value, name in reversed(by):
        pick, why = F.when(test, value).otherwise(pick), F.when(test, name).otherwise(why)
    return d.select("title_id", "rule", pick.alias("id"), why.alias("why"))


def suspects(keys: DataFrame, block: str, key: str = "key", most: int = 2) -> DataFrame:
    """Pairs of different keys within most edits (2 at most) in a block, for a human to look at.

    Keys meet at what is left of them after as many deletions; a block's keys are not paired off.
    """

    def gone(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(x), F.lit(1))), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))

    d = keys.select(block, key).distinct()
    once = gone(F.col(key))
    left = F.concat(F.array(F.col(key)), once, F.flatten(F.transform(once, gone))) if most > 1 else F.concat(F.array(F.col(key)), once)
    near = d.withColumn("variant", F.explode(F.array_distinct(left)))
    pairs = near.withColumnRenamed(key, "a").join(near.withColumnRenamed(key, "b"), [block, "variant"]).filter("a < b").select(block, "a", "b").distinct()
    return pairs.withColumn("distance", F.levenshtein("a", "b", most)).filter("distance >= 0")


def duplicate_edges(records: DataFrame) -> DataFrame:
    """Records (id, key, year) that are one: neighbours among those with equal key whose years don't conflict.

    A record is linked to the first of its (key, year), and that one to the year
    before: a chain instead of all pairs.
    """
    y = records.groupBy("key", "year").agg(F.min("id").alias("first"))
    inside = records.join(y, ["key", "year"]).filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    w = W.partitionBy("key").orderBy("year")
    chain = y.withColumn("a", F.lag("first").over(w)).withColumn("gap", F.col("year") - F.lag("year").over(w)).filter("gap <= 1").select("a", F.col("first").alias("b"))
    return inside.unionByName(chain)


def survivors(members: DataFrame, component: str, order: list[Column]) -> DataFrame:
    """Members with the one that stays of their component: the least by order, found by a partial aggregate."""
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    best = members.groupBy(component).agg(F.min_by("id", key).alias("into"))
    return members.join(best, component).filter("id <> into")


def score(title: Column, query: Column, year: Column, wanted: Column, votes: Column) -> Column:
    """Title 100 if equal, 40 if one holds the other; year 50, 20 one off, else down 10 a year to 5; votes up to 1."""
    t = F.when(title == query, 100).when(F.contains(title, query) | F.contains(query, title), 40).otherwise(0)
    gap = F.abs(year - wanted)
    y = F.coalesce(F.when(gap == 0, 50).when(gap <= 1, 20).otherwise(-10 * F.least(gap, F.lit(5))), F.lit(0))
    return t + y + F.least(votes, F.lit(5000)) / 5000.0


def multi_hall(slots: DataFrame, unrelated: Column, least: int = 2) -> DataFrame:
    """Venues where two unrelated items run at once, at least moments."""
    at = slots.select("venue", "date", "time", "item", "kind").distinct()
    moments = at.groupBy("venue", "date", "time").agg(F.count_distinct("kind").alias("kinds")).filter(unrelated)
    return moments.groupBy("venue").agg(F.count(F.lit(1)).alias("moments")).filter(F.col("moments") >= least)


@F.pandas_udf(T.DoubleType())
def matching_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Share of both texts in matching blocks."""
    for a, b in batches:
        yield pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


def alike_names(rows: DataFrame, block: str, name: str, least: float) -> DataFrame:
    """block, x, y, ratio: different and equal names of a block that are alike; every two names are compared once, however many rows and blocks have them."""
    n = rows.select(block, name).distinct()
    both = n.withColumnRenamed(name, "x").join(n.withColumnRenamed(name, "y"), block)
    scored = both.select("x", "y").distinct().withColumn("ratio", matching_ratio("x", "y")).filter(F.col("ratio") >= least)
    return both.join(scored, ["x", "y"])


_SOUNDS = (("dzh", "j"), ("zh", "j"), ("dj", "j"), ("kh", "h"), ("ph", "f"), ("th", "t"), ("ck", "k"), ("w", "v"), ("y", "i"), ("q", "k"), ("x", "ks"))


def sound_tokens(line: str | None) -> list[str]:
    """The words of a credit line as rough Latin sounds, of three letters and more."""
    s = (line or "").lower().replace("ё", "е")
    s = unicodedata.normalize("NFKD", "".join(text.LETTERS.get(ch, ch) for ch in s))
    s = "".join(ch for ch in s if not unicodedata.combining(ch))
    for a, b in _SOUNDS:
        s = s.replace(a, b)
    s = re.sub(r"(.)\1+", r"\1", re.sub(r"c(?!h)", "k", s))
    return [t for t in re.split("[^a-z]+", s) if len(t) >= 3]


def alike_sounds(a: str, b: str, ratio: float = 0.72, bare: float = 0.8) -> bool:
    """Two sound words: equal, alike, or alike in their consonants."""
    if a == b or SequenceMatcher(None, a, b).ratio() >= ratio:
        return True
    x, y = (re.sub("[aeiou]", "", t) for t in (a, b))
    return min(len(x), len(y)) >= 3 and SequenceMatcher(None, x, y).ratio() >= bare


@F.pandas_udf(T.BooleanType())
def names_agree(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Whether a name of one credit line is one of the other's, in either script; null if either has none."""
    for a, b in batches:
        out = []
        for x, y in zip(map(sound_tokens, a), map(sound_tokens, b), strict=True):
            out.append(any(alike_sounds(p, q) for p in x for q in y) if x and y else None)
        yield pd.Series(out, dtype=object)


@F.pandas_udf(T.BooleanType())
def titles_agree(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Whether two Latin titles are one: equal or one in the other once folded, or nearly the same spelling."""
    for a, b in batches:
        out = []
        for x, y in zip(a, b, strict=True):
            p, q = (re.sub("[^a-z0-9]", "", (v or "").lower()) for v in (x, y))
            near = bool(p and q) and (p == q or (min(len(p), len(q)) >= 4 and (p in q or q in p)) or SequenceMatcher(None, p, q).ratio() >= 0.85)
            out.append(near)
        yield pd.Series(out, dtype=object)


def plausible_year(year: Column, other: Column, rerelease: Column, most: int = 5) -> Column:
    """Whether two years may be one film's: most apart at most, or the other older where the title is marked as a new edition; unknown ones may."""
    near = F.coalesce(F.abs(year - other) <= most, F.lit(True))
    return near | (F.coalesce(rerelease, F.lit(False)) & F.coalesce(other <= year, F.lit(False)))


def local_pick(results: DataFrame) -> DataFrame:
    """qid, id: of search results for a Bulgarian title the best of 60 points or more.

    results: qid, q, year, id, title, original, ry, votes; n, if given: how many results a row stands for.
    Equal titles give 100, one in the other 60 if it is most of it and more than a word, or the year confirms it;
    the year 20, votes up to 1.  An older namesake of a result that is far older than the title's year leaves both out.
    """
    times = F.col("n") if "n" in results.columns else F.lit(1)
    q, t, o = (text.latin_norm(F.col(c), cyrillic=True) for c in ("q", "title", "original"))
    d = results.withColumns({"nq": q, "nt": t, "no": o}).filter("nq <> ''")
    same = (F.col("nq") == F.col("nt")) | (F.col("nq") == F.col("no"))
    inside = (F.length("nq") >= 6) & (F.contains("nt", "nq") | ((F.col("nt") != "") & F.contains("nq", "nt")))
    short, long = F.least(F.length("nq"), F.length("nt")), F.greatest(F.length("nq"), F.length("nt"))
    weak = (F.size(F.split(F.trim("q"), r"\s+")) < 2) | (short < 0.5 * long)
    confirmed = F.coalesce(F.abs(F.col("ry") - F.col("year")) <= 1, F.lit(False))
    base = F.when(same, 100.0).when(inside & (~weak | confirmed), 60.0)
    points = base + F.when(F.coalesce(F.col("ry") == F.col("year"), F.lit(False)), 20.0).otherwise(0.0) + F.least(F.coalesce("votes", F.lit(0)), F.lit(5000)) / 5000.0
    d = d.withColumn("points", points).withColumn("namesake", same & (F.coalesce("ry", F.col("year") + 1) <= F.col("year")))
    g = d.groupBy("qid").agg(F.max(F.when(F.col("points") >= 60, F.struct("points", (-F.col("id")).alias("i"), "ry", "year", "namesake"))).alias("x"), F.sum(F.when(F.col("namesake"), times).otherwise(0)).alias("old"))
    far = ~F.coalesce(F.abs(F.col("x.ry") - F.col("x.year")) <= 5, F.lit(True))
    twin = far & (F.col("old") - F.col("x.namesake").cast("int") > 0)
    return g.filter(F.col("x").isNotNull() & ~twin).select("qid", (-F.col("x.i")).alias("id"))


def local_picks(queries: DataFrame, results: DataFrame, by: list[str]) -> DataFrame:
    """qid, id: local_pick of each query (qid, q, year) among the results (id, title, original, ry, votes) with equal values of by.

    Equal queries are asked once.  Of results equal in title, original and ry the one of most votes, then of the smallest
    id, stands for all and brings their number, so a pair is of texts, however many rows have them.
    """
    ask = [*by, "q", "year"]
    # written, so that both uses have one number for a question
    asked = graph.cut(queries.select(*ask).distinct().withColumn("ask", F.monotonically_increasing_id()))
    votes = F.least(F.coalesce("votes", F.lit(0)), F.lit(5000))
    best = F.max_by(F.struct("id", "votes"), F.struct(votes, -F.col("id")))
    few = results.groupBy(*by, "title", "original", "ry").agg(best.alias("x"), F.count(F.lit(1)).alias("n"))
    few = few.select(*by, "title", "original", "ry", "x.id", "x.votes", "n")
    picked = local_pick(asked.withColumnRenamed("ask", "qid").join(few, by)).select(F.col("qid").alias("ask"), "id")
    known = asked.join(graph.large(picked), "ask").select(*[F.col(c).alias(f"__{c}") for c in ask], "id")
    same = F.lit(True)
    for c in ask:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return queries.join(known, same).select("qid", "id")


def sole_match(queries: DataFrame, entries: DataFrame, keys: list[str], fits: Column) -> DataFrame:
    """qid, id: the entry with equal keys that fits, if exactly one does (lookups by director, runtime or printed id)."""
    d = queries.join(entries, keys).filter(F.coalesce(fits, F.lit(False))).select("qid", "id").distinct()
    return d.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).filter("n = 1").select("qid", "id")


def title_matcher(titles: DataFrame, index: DataFrame) -> DataFrame:
    """title_id, id: the index entry with the title's key, else the only one whose words begin with the title's or the reverse.

    A key's or a beginning's entries go by the first and the last id: one entry alone has both equal, and no title meets all entries.
    """
    def ends(d: DataFrame, by: str) -> DataFrame:
        return d.groupBy(by).agg(F.min("id").alias("id"), F.max("id").alias("last"))

    keys = ends(index, "key")
    same = titles.join(graph.large(keys), "key").groupBy("title_id").agg(F.min("id").alias("id"))
    rest = titles.join(same.select("title_id"), "title_id", "left_anti")

    def heads(d: DataFrame, name: str) -> DataFrame:
        w = F.split("key", " ")
        return d.select(name, F.explode(F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(w))), lambda k: F.array_join(F.slice(w, F.lit(1), k), " "))).alias("head")).distinct()

    a = heads(rest, "title_id").join(graph.large(keys.withColumnRenamed("key", "head")), "head").select("title_id", "id", "last")
    b = rest.select("title_id", F.col("key").alias("head")).join(graph.large(ends(heads(index, "id"), "head")), "head").select("title_id", "id", "last")
    one = a.unionByName(b).groupBy("title_id").agg(F.min("id").alias("id"), F.max("last").alias("last")).filter("id = last").select("title_id", "id")
    return same.unionByName(one)
