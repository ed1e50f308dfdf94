"""Scenarios of the listing operators on small tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from plumbline import sources
from plumbline.functions import html, text, urls
from plumbline.operators import calendar, coverage, graph, identity, merge, quality, scan, state

SLOT = "venue long, item long, date date, time string"


def day(n: int, month: int = 6) -> dt.date:
    return dt.date(1998, month, n)


def venue(spark, status="official", cf=day(1), ct=day(2), fetched=True, prev=None, confirmed=None, expired=False):
    schema = "venue long, status string, cf date, ct date, fetched boolean, prev_prelim date, confirmed_to date, expired boolean"
    return spark.createDataFrame([(1, status, cf, ct, fetched, prev, confirmed, expired)], schema)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_official_source_inside_coverage(spark):
    o = spark.createDataFrame([(1, 7, day(1), "11:00")], SLOT)
    s = spark.createDataFrame([(1, 7, day(1), "12:00"), (1, 8, day(3), "13:00")], SLOT)
    got, log = merge.authoritative_merge(o, s, o.limit(0), venue(spark), "1998-06-01", "1998-08-06")
    assert rows(got, "item", "date", "time", "source") == [(7, day(1), "11:00", "official"), (8, day(3), "13:00", "secondary")]
    assert rows(log, "item", "time", "reason") == [(7, "12:00", "discarded")]
    assert merge.prelim_from(venue(spark), "1998-06-01").first()["prelim_from"] == day(3)


def test_failed_source_keeps_rows_until_they_expire(spark):
    p = spark.createDataFrame([(1, 7, day(1), "11:00")], SLOT)
    s = spark.createDataFrame([(1, 7, day(1), "12:00"), (1, 8, day(9), "13:00")], SLOT)
    kept, log = merge.authoritative_merge(p.limit(0), s, p, venue(spark, "unreachable", confirmed=day(3)), "1998-06-01", "1998-08-06")
    assert rows(kept, "item", "source") == [(7, "previous"), (8, "secondary")] and rows(log, "reason") == [("kept row wins",)]
    gone, _ = merge.authoritative_merge(p.limit(0), s, p, venue(spark, "unreachable", confirmed=day(3), expired=True), "1998-06-01", "1998-08-06")
    assert rows(gone, "item", "source") == [(7, "secondary"), (8, "secondary")]
    state_rows = spark.createDataFrame([(1, day(1), None), (2, day(2), None), (3, None, None)], "venue long, last_ok date, failing_since date")
    assert rows(calendar.keep_policy(state_rows, "1998-06-16"), "venue", "age", "expired") == [(1, 15, True), (2, 14, False), (3, 0, False)]


def test_first_writer_and_excluded_keys(spark):
    a, b = (spark.createDataFrame(x, SLOT) for x in ([(1, 1, day(1), "a")], [(1, 1, day(1), "a"), (1, 2, day(1), "b"), (1, 3, day(1), "c")]))
    out = merge.first_writer_merge([a, b], b.filter("item = 2"), ["venue", "item", "date", "time"])
    assert rows(out, "item", "rank") == [(1, 0), (3, 1)]


def test_pairs_are_one_to_one(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "x", 2), (3, "y", 9)], "left_id long, k string, t long")
    b = spark.createDataFrame([(10, "x", 2), (11, "x", 7), (12, "z", 1)], "right_id long, k string, t long")
    assert rows(merge.reconcile_passes(a, b, [["k", "t"], ["k"]], "left_id", "right_id"), "left_id", "right_id", "pass") == [(1, 11, 2), (2, 10, 1)]


def test_nearest_within(spark):
    a = spark.createDataFrame([(1, 0, 100), (2, 0, 500)], "l long, k long, m long")
    b = spark.createDataFrame([(5, 0, 190), (6, 0, 11), (7, 0, 10), (8, 1, 100), (9, 0, 591)], "r long, k long, m long")
    assert rows(merge.nearest_within(a, b, ["k"], "m", 90, "l", "r"), "l", "r", "gap") == [(1, 6, 89)]


def test_islands_round_trip(spark):
    d = spark.createDataFrame([(1, day(1)), (1, day(2)), (1, day(4)), (2, dt.date(1998, 12, 31)), (2, dt.date(1999, 1, 1))], "k long, date date")
    runs = calendar.islands(d, ["k"])
    assert rows(runs, "k", "days") == [(1, 1), (1, 2), (2, 2)]
    assert rows(calendar.days_of(runs, ["k"]), "k", "date") == rows(d, "k", "date")


def test_first_thin_day_counts_if_the_second_is_fine(spark):
    n = [1, 10, 10, 12, 9, 10, 10, 10, 1, 10]
    d = spark.createDataFrame([(1, day(i + 1), v) for i, v in enumerate(n)], "k long, date date, n long")
    assert rows(calendar.published_through(d, ["k"]), "k", "through") == [(1, day(8))]


def test_month_needs_fourteen_reference_days(spark):
    def judged(days):
        d = [(1, day(31, 5) - dt.timedelta(i), 1) for i in range(days)] + [(1, day(i), 1) for i in range(1, 31)]
        return {r["month"]: r["complete"] for r in calendar.month_complete(spark.createDataFrame(d, "k long, date date, n long"), ["k"]).collect()}[day(1)]

    assert judged(14) and not judged(13)


def test_empty_set_is_covered(spark):
    d = spark.range(1).select(coverage.percent(F.lit(0), F.lit(0)).alias("p"), coverage.percent(F.lit(1), F.lit(3)).alias("q")).first()
    assert (d["p"], d["q"]) == (100.0, 33.3)


def test_budget_selects_the_first_anyway(spark):
    d = spark.createDataFrame([(1, "a", 50), (2, "a", 5), (3, "b", 5), (4, "b", 4), (5, "b", 9)], "id long, g string, n long")
    assert rows(state.budget_prefix(d, "g", ["id"], "n", 10), "id") == [(1,), (3,), (4,)]
    fit = scan.next_fit(d, "g", "id", "n", 2, 10)
    assert rows(fit, "id", "batch") == [(1, 0), (2, 1), (3, 0), (4, 0), (5, 1)]


def test_merge_chains_and_cycles(spark):
    d = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (6, 5), (9, 8)], "old long, into long")
    assert rows(graph.redirects(d), "old", "final") == [(1, 3), (2, 3), (5, 5), (6, 5), (9, 8)]
    e = spark.createDataFrame([(1, 2), (2, 3), (7, 6), (4, 4)], "a long, b long")
    assert rows(graph.components(e), "node", "root") == [(1, 1), (2, 1), (3, 1), (6, 6), (7, 6)]


def test_title_rules(spark):
    cat = spark.createDataFrame([(1, "Пепел (1990)", 1990, False), (2, "Nosferatu", 1922, False), (3, "Nosferatu", 2024, False), (4, "Падане 2: Мъртва точка", 2026, False), (5, "Casablanca", 1942, True), (6, "Casablanca", None, False)], "id long, title string, year int, minted boolean")
    tit = spark.createDataFrame([(1, "ПЕПЕЛ", None), (2, "Nosferatu", None), (3, "nosferatu 3D", 2024), (4, "Падане 2", 2026), (5, "Cassablanca", None), (6, "Nosferatu", 1950), (7, "Пепел", 1988)], "title_id long, title string, year int")
    got = {r["title_id"]: (r["id"], r["why"]) for r in identity.choose(identity.candidates(tit, cat)).collect()}
    assert got == {1: (1, "single"), 2: (None, "ambiguous"), 3: (3, "single"), 4: (4, "single"), 5: (6, "catalogue")}


def test_one_edit_keeps_numbers_apart(spark):
    a = spark.createDataFrame([(1, "the big film 2"), (2, "the big films 2"), (3, "short 1")], "l long, key string")
    b = spark.createDataFrame([(1, "the big film 3"), (2, "the big film 2"), (3, "short 2")], "r long, key string")
    assert rows(identity.one_edit(a, b, "l", "r"), "l", "r") == [(2, 2)]


def test_text(spark):
    t = spark.createDataFrame([("  «Ёлки» & ко – IMAX (2010) ",), ("Жълт: щъркел",), ("Rock & Roll's",)], "t string")
    got = t.select(text.key(F.col("t")).alias("k"), text.base_key(F.col("t")).alias("b"), text.title_year(F.col("t")).alias("y"), text.translit(text.key(F.col("t"))).alias("l")).collect()
    assert [tuple(r) for r in got] == [("елки и ко", None, 2010, "elki i ko"), ("жълт щъркел", "жълт", None, "zhalt shtarkel"), ("rock and rolls", None, None, "rock and rolls")]
    s = spark.createDataFrame([("GET https://u:pw@h/x?api_key=abc&b=1 Authorization: Bearer zzz",)], "t string").select(text.scrub(F.col("t")).alias("s")).first()["s"]
    assert s == "GET https://u:***@h/x?api_key=***&b=1 Authorization: Bearer ***".replace("u:***", "***")


def test_urls(spark):
    u = spark.createDataFrame([("HTTPS://www.A.B.Example.com:80/x/y.png?q",), ("no url",)], "u string")
    got = u.select(urls.host(F.col("u")).alias("h"), urls.site(F.col("u")).alias("s"), urls.stem(F.col("u")).alias("p")).collect()
    assert [tuple(r) for r in got] == [("a.b.example.com", "example.com", "y"), ("", "", "")]


def test_pages():
    page = "<head><title>t</title></head><nav>menu</nav><p>Cast: A, B: C</p><p>One two three four five six seven eight nine ten eleven twelve thirteen.<br>more</p>"
    assert html.paragraphs_of(page)[1].startswith("One two") and [html.is_prose(p) for p in html.paragraphs_of(page)] == [False, True, False]


def test_embedded_constant():
    script = 'const A = [1]; /* const B = [9] */ let B = [["x]", 2, /* c */ {"k": [1]}], // end\n ["it\\"s, ]", null,],];'
    assert sources.constant(script.replace("/* const B = [9] */", ""), "B") == [["x]", 2, {"k": [1]}], ['it"s, ]', None]]
    assert sources.constant("nothing", "B") is None and sources.constant(None, "B") is None


def test_sidecar(spark, tmp_path):
    assert sources.read_sidecar(spark, f"{tmp_path}/none.json", "a long").count() == 0
    (tmp_path / "x.json").write_text('{"a": 1}\nbroken\n')
    assert sorted(str(r["a"]) for r in sources.read_sidecar(spark, f"{tmp_path}/x.json", "a long").collect()) == ["1", "None"]


def test_removed_only_where_read(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 1, "a")], "venue long, item long, v string")
    new = spark.createDataFrame([(1, 2, "b")], "venue long, item long, v string")
    got = quality.snapshot_diff(old, new, ["venue", "item"], "v", spark.createDataFrame([(1,)], "venue long"), "venue")
    assert rows(got, "venue", "item", "change") == [(1, 1, "removed"), (1, 2, "added")]
