"""Findings of the second report, each with a case that failed before."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from plumbline.operators import identity


def joined_rows(d):
    """Rows that the joins of a query make, as its run counted them."""
    d.collect()
    made, todo = [], [d._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(p.plan())
            continue
        if "Join" in name and p.metrics().contains("numOutputRows"):
            made.append(p.metrics().apply("numOutputRows").value())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return max(made, default=0)


def test_local_picks_meet_by_text(spark):
    q = [(k, n, y) for k, (n, y) in enumerate(product(["old ring", "old bolt"], [2000, 2001, None]))] * 1
    q += [(k + 100, n, y) for k, n, y in q]
    c = [(k, t, "", ry, 3 * k) for k, (t, ry, _) in enumerate(product(["old ring", "old ring two", "old", "bolt"], [1990, 2000, 2001, None], range(40)))]
    queries = spark.createDataFrame(q, "qid long, q string, year int").withColumn("w", F.split("q", " ")[0])
    results = spark.createDataFrame(c, "id long, title string, original string, ry int, votes long").withColumn("w", F.split("title", " ")[0])
    want = identity.local_pick(queries.join(results, "w"))
    got = identity.local_picks(queries, results, ["w"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 0
    assert joined_rows(got) <= 6 * 12 < joined_rows(want)


def test_title_matches_meet_first_and_last_entries_only(spark):
    i = [(k, f"old ring {k % 3}") for k in range(300)] + [(900, "blue bolt one"), (901, "cold plate")]
    t = [(k, "old ring") for k in range(200)] + [(500, "blue bolt"), (501, "cold plate with words"), (502, "old ring 1"), (503, "cold plate")]
    d = identity.title_matcher(spark.createDataFrame(t, "title_id long, key string"), spark.createDataFrame(i, "id long, key string"))
    assert sorted(map(tuple, d.collect())) == [(500, 900), (501, 901), (502, 1), (503, 901)]
    assert joined_rows(d) <= 500


def plain_passes(ps, ts):
    """The four passes by rounds of mutual first choices among all pairs."""
    def begins(a, b):
        return min(len(a.split(" ")), len(b.split(" "))) >= 2 and ((a + " ").startswith(b + " ") or (b + " ").startswith(a + " "))

    def share(a, b):
        x, y = ({w for w in k.split(" ") if len(w) >= 4} for k in (a, b))
        return bool(x & y) and 2 * len(x & y) >= min(len(x), len(y))

    out = []
    tests = [lambda p, t: p[3] == t[3] and p[1] == t[1], lambda p, t: p[3] == t[3] and begins(p[1], t[1]), lambda p, t: p[3] == t[3] and share(p[1], t[1]), lambda p, t: p[1] == t[1] or begins(p[1], t[1])]
    for number, test in enumerate(tests, 1):
        d = [(p[0], t[0]) for p in ps for t in ts if p[2] == t[2] and test(p, t)]
        while d:
            if number == 3:
                best = [(p, t) for p, t in d if sum(x == p for x, _ in d) == 1 and sum(y == t for _, y in d) == 1]
            else:
                best = [(p, t) for p, t in d if t == min(y for x, y in d if x == p) and p == min(x for x, y in d if y == t)]
            out += [(*x, number) for x in best]
            d = [] if number == 3 else [(p, t) for p, t in d if p not in {x for x, _ in best} and t not in {y for _, y in best}]
        ps, ts = [p for p in ps if p[0] not in {x[0] for x in out}], [t for t in ts if t[0] not in {x[1] for x in out}]
    return {*out, *((p[0], None, 5) for p in ps), *((None, t[0], 5) for t in ts)}


def test_reconcile_is_the_rounds_of_first_choices(spark):
    import random

    from plumbline.operators import theatre

    r = random.Random(5)
    titles = ["old ring", "old ring two", "old ring two more", "old", "golden bolt evening", "evening bolt golden", "golden evening", "bolt", ""]

    def rows(n, start):
        return [(start + i, r.choice(titles), r.choice(["a", "b", "c"]), r.choice(["15:00", "16:00", "17:00"])) for i in r.sample(range(3 * n), n)]

    p, t = rows(90, 0), rows(70, 50)
    d = theatre.reconcile(*(spark.createDataFrame(x, "id long, key string, date string, time string") for x in (p, t)))
    got = [tuple(x) for x in d.collect()]
    assert set(got) == plain_passes(p, t) and len(got) == len(set(got)) and {x[2] for x in got} == {1, 2, 3, 4, 5}
    odd = [(900, None, "a", "15:00"), (901, "old ring", None, "15:00"), (902, "old ring", "z", None), (None, "old ring", "a", "15:00")]
    d = theatre.reconcile(*(spark.createDataFrame(odd, "id long, key string, date string, time string") for _ in range(2)))
    assert sorted(map(str, (tuple(x) for x in d.collect()))) == sorted(map(str, [(902, 902, 4), *((i, None, 5) for i in (900, 901, None)), *((None, i, 5) for i in (900, 901, None))]))


def test_reconcile_of_a_long_day_makes_no_pairs(spark):
    import time

    from plumbline.operators import theatre

    p = spark.range(20_000).selectExpr("id", "'grand opera' key", "1 date", "'19:00' time")
    t = spark.range(20_000).selectExpr("id + 7 as id", "if(id % 2 = 0, 'grand opera', 'grand opera by candlelight') key", "1 date", "'19:00' time")
    began = time.monotonic()
    assert {(r["pass"], r["count"]) for r in theatre.reconcile(p, t).groupBy("pass").count().collect()} == {(1, 10_000), (2, 10_000)}
    assert time.monotonic() - began < 60


def test_same_events_meet_as_units(spark, monkeypatch):
    import datetime
    import random

    from plumbline.operators import events

    r, day = random.Random(3), datetime.date(1998, 1, 1)
    rows = []
    for i in range(300):
        first = day + datetime.timedelta(days=r.choice([0, 3, 30, 31, 33, 90]))
        rows.append((i, r.choice([["old", "ring"], ["old", "ring", "festival"], ["old"], ["longer12", "old"], ["longer12", "longer34"], ["1999"], ["ring", "blue", "old"]]), first, first + datetime.timedelta(days=r.choice([0, 2, 40]))))
    rows.append((7, ["longer34", "blue"], day, day + datetime.timedelta(days=200)))

    def clean(w):
        return {x for x in w if x != "festival" and len(x) >= 2 and not x[0].isdigit()}

    want = set()
    for x in rows:
        for y in rows:
            a, b = clean(x[1]), clean(y[1])
            if x[0] < y[0] and a and b and x[2] <= y[3] and y[2] <= x[3] and (a <= b or b <= a or any(len(w) >= 8 for w in a & b)):
                want.add((x[0], y[0]))
    d = spark.createDataFrame(rows, "id long, words array<string>, first date, last date")
    for unit in (1000, 2):
        monkeypatch.setattr(events, "UNIT", unit)
        pairs = events.same_event_pairs(d, ["festival"], 8)
        got = [tuple(x) for x in pairs.collect()]
        assert set(got) == want and len(got) == len(want)
    copies = spark.range(400).selectExpr("id", "array('longer12', 'old') words", "date'1998-01-01' first", "date'1998-01-02' last")
    monkeypatch.setattr(events, "UNIT", 1000)
    pairs = events.same_event_pairs(copies, ["festival"], 8)
    assert pairs.count() == 400 * 399 // 2 and joined_rows(pairs) <= 400


def test_most_windows_of_a_text_are_not_searched_for():
    import numpy as np

    from plumbline.llm.decontamination import Sieve

    h = np.random.default_rng(1).integers(0, 2**64, 200_000, dtype=np.uint64)
    known, others = h[:5_000], h[5_000:]
    s = Sieve(known)
    assert len(s.holds(known)) == len(known) and len(s.holds(others)) < len(others) / 12
    assert len(Sieve(known[:0]).holds(h)) == 0 and len(s.holds(h[:0])) == 0
