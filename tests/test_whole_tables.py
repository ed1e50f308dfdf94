"""Queries without SQL against brute force over whole tables."""

from __future__ import annotations

from difflib import SequenceMatcher

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_name_similarity_over_all_parts(spark):
    rows = sorted((r["p_partkey"], r["p_name"], r["p_size"]) for r in spark.read.parquet(f"{SF}/part.parquet").collect())
    want = {(a, b): SequenceMatcher(None, x, y).ratio() for a, x, m in rows for b, y, n in rows if a < b and m == n}
    got = {(r["a"], r["b"]): r["ratio"] for r in entry.registry.QUERIES["name_similarity"](spark, SF).collect()}
    assert got == {k: round(v, 6) for k, v in want.items() if round(v, 6) >= 0.72}
    assert any(a % 10 for a, _ in got)
