"""Named queries with their equivalent SQL.

``@query("name", oracle="SELECT ...")`` registers ``f(spark, sf_dir)``.  The
SQL runs on the same Parquet tables registered as views; a query without SQL is
checked by tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add
