"""Findings of the fourth report, each with a case that failed before."""

from __future__ import annotations

from plumbline.operators import resolution


def test_rules_after_the_wanted_one_are_not_looked_for(spark, monkeypatch):
    f = [(1, "golden bolt evening", 2000), (2, "silver ring: first light", 2001), (3, "old plate morning", 2002), (4, "copper gear", 2003)]
    films = spark.createDataFrame([(k, b, None, None, y, 90, False) for k, b, y in f], "id long, bg string, en string, original string, year int, runtime int, minted boolean")
    t = [(10, "golden bolt evening"), (11, "silver ring"), (12, "old plate mornings"), (13, "known as bolt"), (14, "copper gear"), (15, "old plate morning")]
    titles = spark.createDataFrame([(k, x, 1, {11: 2001}.get(k), 90, None) for k, x in t], "title_id long, title string, venue long, year int, runtime int, original string")
    # the number of the last group puts it behind two rules
    a = [(5, "known as bolt", 1), (6, "copper gear", 1), (2_000_000, "old plate morning", 1)]
    aliases = spark.createDataFrame([(g, x, i, []) for g, x, i in a], "grp long, title string, film long, venues array<long>")
    moves = spark.createDataFrame([], "old long, final long")
    listed = spark.createDataFrame([], "title_id long, id long")

    def placed(**wanted):
        return {tuple(r) for r in resolution.resolve(titles, films, aliases, moves, listed, **wanted).placed.collect()}

    want = placed()
    assert {(k, r, i) for k, r, i, _ in want} == {(10, 2, 1), (11, 5, 2), (12, 6, 3), (13, 1, 1), (14, 1, 1), (15, 2, 3)}

    def no_edits(*_):
        raise AssertionError("spellings are looked for")

    monkeypatch.setattr(resolution, "one_edit", no_edits)
    for last in (resolution.ALIAS, resolution.EXACT, resolution.SUBTITLE):
        assert {x for x in placed(last=last) if x[1] <= last} == {x for x in want if x[1] <= last}


def test_a_venue_of_one_common_word_is_not_paired_off(spark):
    import time

    from pyspark.sql import functions as F

    from plumbline.operators import duplicates

    ev = spark.range(30_000).select("id", F.concat(F.lit("grand w"), "id").alias("key"))
    slots = ev.select("id", F.lit("one").alias("venue"), F.explode(F.array(F.lit(1), F.lit(2))).alias("date"), F.lit("19:00").alias("time"))
    began = time.monotonic()
    assert duplicates.multi_hall_venues(ev, slots).isEmpty()
    assert time.monotonic() - began < 40


def test_halls_are_those_of_all_pairs(spark):
    import random
    from itertools import combinations

    from plumbline.operators import duplicates

    r = random.Random(4)
    keys = {i: r.choice(["a b", "b c", "a c", "a", "c d", "d", "a b c", None]) for i in range(60)}
    slots = [(r.choice(list(keys) + [900]), r.choice("uvwxyz"), r.choice([1, 2, None]), r.choice([1, 2])) for _ in range(90)]
    slots += [(i, "one", d, 1) for i, k in keys.items() if k and "a" in k.split() for d in (1, 2)]
    slots += [(i, "ring", d, 1) for i, k in keys.items() if k in ("a b", "b c", "a c") for d in (1, 2)] * 2
    at = {}
    for i, *x in slots:
        at.setdefault(tuple(x), set()).add(i)
    want = {}
    for (v, *_), films in at.items():
        words = [set(keys[i].split()) for i in films if keys.get(i)]
        want[v] = want.get(v, 0) + any(not p & q for p, q in combinations(words, 2))
    ev = spark.createDataFrame(list(keys.items()), "id long, key string")
    got = [x["venue"] for x in duplicates.multi_hall_venues(ev, spark.createDataFrame(slots, "id long, venue string, date int, time int")).collect()]
    assert sorted(got) == sorted(v for v, n in want.items() if n >= 2) and got and "one" not in got and "ring" not in got
