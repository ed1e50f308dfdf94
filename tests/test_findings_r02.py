"""Findings of round 2, each with a case that failed before."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import identity


def plan(d):
    return d._jdf.queryExecution().optimizedPlan().toString()


def test_filter_on_a_key_does_not_repeat_the_cleaning(spark):
    d = spark.createDataFrame([(1, "Премиера: Old Ring (1999)"), (2, "")], "id long, t string")
    kept = text.with_keys(d, "t").filter("key <> ''").select("id", "key")
    assert [tuple(r) for r in kept.collect()] == [(1, "old ring")]
    assert plan(kept).count("regexp_replace") < 100


def test_one_edit_has_no_pattern_among_its_join_keys(spark):
    a = spark.createDataFrame([(1, "golden rings 1"), (2, "golden rings 2"), (3, "golden ringing")], "x long, key string")
    b = spark.createDataFrame([(7, "golden ring 1"), (8, "golden rings 1"), (9, "goldenrings 1"), (10, "golden rings 1x")], "y long, key string")
    d = identity.one_edit(a, b, "x", "y")
    assert {tuple(r) for r in d.collect()} == {(1, 7), (1, 10)}
    joins = [line for line in d._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]
    assert joins and not any("regexp" in line.split("Inner")[0] for line in joins)


def test_compact_votes_rounds_ties_as_c_does(spark):
    ties = [u + i * (u // 20) for u in (1_000, 1_000_000) for i in range(0, 400)]
    n = [*ties, *(t - 1 for t in ties), *(t + 1 for t in ties), 999, 1_000, 999_949, 999_950, 999_999]
    d = spark.createDataFrame([(x,) for x in n], "n long").select("n", text.compact_votes(F.col("n")).alias("c"))
    want = {x: f"{x / 1e6:.1f}M" if x >= 1_000_000 else f"{x / 1e3:.1f}K" if x >= 1_000 else str(x) for x in n}
    assert {r.n: r.c for r in d.collect()} == want


def test_festival_slots_meet_at_keys_as_well(spark):
    from plumbline.operators import resolution

    films = spark.createDataFrame([(1, "old ring: gala", 1999), (2, "old", 1999), (3, "blue bolt", 1999), (4, "стар", 1999), (5, "old ringing", 1999)], "id long, bg string, year int")
    films = films.selectExpr("id", "bg", "cast(null as string) en", "cast(null as string) original", "year", "cast(null as int) runtime", "true minted")
    titles = spark.createDataFrame([(10, "Old Ring", 2000, 1), (11, "star", 1999, 2), (12, "old town", 1999, 3), (13, "blue bolt", 1990, 3)], "title_id long, title string, year int, time int").selectExpr("*", "1 venue", "1 date")
    own = spark.createDataFrame([(1, 1), (3, 1), (5, 1), (4, 2), (2, 3), (3, 3)], "id long, time int").selectExpr("*", "1 venue", "1 date")
    d = resolution.festival_slot_rule(titles, own, films)
    assert {tuple(r) for r in d.collect()} == {(10, 1), (11, 4), (12, 2)}
    joins = [line for line in d._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]
    assert any("mark" in line for line in joins)


def test_shards_of_many_items_in_little_time(spark):
    import time

    from plumbline.operators import control

    d = spark.range(60_000).selectExpr("1 as group", "id as position", "id as item", "id % 500 as seconds")
    began = time.monotonic()
    loads = control.shards(d, 3000).join(d.select("item", "seconds"), "item").groupBy("bin").agg(F.sum("seconds").alias("s")).collect()
    assert max(r.s for r in loads) <= 3000 and sum(r.s for r in loads) == 14_970_000
    assert time.monotonic() - began < 60
