"""Every registered query against its SQL."""

from __future__ import annotations

import decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(n for n in entry.registry.QUERIES))
def test_query(spark, duck, name):
    df = entry.registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in entry.registry.ORACLES:
        assert columns
        return
    want = duck.sql(entry.registry.ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


def test_entry(spark):
    assert entry.entry(spark).columns
