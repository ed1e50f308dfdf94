"""URL filters by a sort-merge range join.

A host is turned into a canonical key: its labels in reverse, each followed by
a dot (``com.example.``).  A rule for a host and its subdomains is then the
interval of all keys that start with the rule's key, and intervals of rules are
nested or disjoint.  Pages sorted by key and rules sorted by key are swept
together; a stack holds the rules whose interval is open, innermost on top.
Among them the longest rule whose path is a prefix of the page's path decides.

Up to ``BROADCAST_RULES`` rules are sent to every task, and each task sorts and
sweeps its own pages: no page is shuffled, so a hot host costs nothing.  Beyond
that, rules are cut into key ranges, each range gets the rules that begin in it
and the chain of rules still open at its lower end, and pages go to their range;
a range with many pages is split by salt, and its rules are repeated for each salt by a join.

Null urls, and urls without ``://``, have empty host and path.  Rules with the
same host and path: the first in (verdict, rule) order counts.  Repeated rows
are judged one by one.  Only the id and url columns are read, so extra columns
don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path)
Rule = tuple[str, str, str]
BROADCAST_RULES = 100_000
RANGE_RULES = 20_000
RANGE_PAGES = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def rule_key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "." if host else ""


def _grouped(rules: Iterable[Rule]) -> list[tuple[str, list[tuple[str, str, str]]]]:
    """Rules by key in key order; within a key the longest path first."""
    by: dict[str, dict[str, tuple[str, str, str]]] = {}
    for verdict, host, path in sorted(rules):
        by.setdefault(rule_key(host), {}).setdefault(path, (path, verdict, host + path))
    return [(k, sorted(v.values(), key=lambda r: (-len(r[0]), r))) for k, v in sorted(by.items())]


def sweep(pages: Iterable[tuple[str, str]], rules: Sequence[tuple[str, list[tuple[str, str, str]]]]) -> Iterator[tuple[str | None, str | None]]:
    """(rule, verdict) for each (key, path) of pages, which are in key order."""
    stack: list[tuple[str, list[tuple[str, str, str]]]] = []
    at = 0
    for key, path in pages:
        while at < len(rules) and rules[at][0] <= key:
            while stack and not rules[at][0].startswith(stack[-1][0]):
                stack.pop()
            stack.append(rules[at])
            at += 1
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        best = max((r for _, own in stack for r in own if path.startswith(r[0])), key=lambda r: len(r[2]), default=None)
        yield (None, None) if best is None else (best[2], best[1])


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """id_col, host, path, rule (null if none fits), verdict (the rule's, else default)."""
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    # ids travel as text: pandas would make numbers with nulls among them inexact
    rows = pages.select(F.col(id_col).cast("string").alias(id_col), host.alias("host"), path.alias("path")).withColumn("__key", host_key(F.col("host")))
    out, id_type = f"`{id_col}` string, host string, path string, rule string, verdict string", pages.schema[id_col].dataType
    table = _grouped(rules)

    def swept(batches: Iterator[pd.DataFrame], own: Sequence) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def keys() -> Iterator[tuple[str, str]]:
            for b in batches:
                held.append(b)
                yield from zip(b["__key"], b["path"], strict=True)

        found: list[tuple] = []
        for r in sweep(keys(), own):
            found.append(r)
            if len(found) == len(held[0]):
                b = held.pop(0)
                yield b.drop(columns="__key").assign(rule=[r for r, _ in found], verdict=[v or default for _, v in found])
                found = []

    if len(rules) <= broadcast_rules:
        sent = pages.sparkSession.sparkContext.broadcast(table)
        judged = rows.sortWithinPartitions("__key").mapInPandas(lambda it: swept((b for b in it if len(b)), sent.value), out)
        return judged.withColumn(id_col, F.col(id_col).cast(id_type))

    # ranges of rules; each has the chain of rules that are open at its lower end
    starts = list(range(0, len(table), RANGE_RULES))
    chains: list[list] = []
    stack: list = []
    for i, entry in enumerate(table):
        while stack and not entry[0].startswith(stack[-1][0]):
            stack.pop()
        if i % RANGE_RULES == 0:
            chains.append(list(stack))
        stack.append(entry)
    lows = pages.sparkSession.sparkContext.broadcast([table[i][0] for i in starts])

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return key.map(lambda k: max(0, bisect_right(lows.value, k) - 1)).astype("int32")

    rows = rows.withColumn("__range", range_of("__key"))
    salts = rows.groupBy("__range").count().select("__range", F.ceil(F.greatest(F.col("count"), F.lit(1)) / RANGE_PAGES).cast("int").alias("__salts"))
    # a row a range of rules: as many as there are rules in RANGE_RULES
    rows = rows.join(F.broadcast(salts), "__range").withColumn("__salt", F.pmod(F.xxhash64(id_col, "path"), F.col("__salts")).cast("int")).drop("__salts")
    sent = [(n, k, *r) for n, i in enumerate(starts) for k, own in [*chains[n], *table[i : i + RANGE_RULES]] for r in own]
    entries = pages.sparkSession.sparkContext.parallelize(sent, max(1, len(starts))).toDF("__range int, key string, path string, verdict string, rule string")
    entries = entries.join(F.broadcast(salts), "__range").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        own: dict[str, list] = {}
        for k, p, v, r in zip(right["key"], right["path"], right["verdict"], right["rule"], strict=True):
            own.setdefault(k, []).append((p, v, r))
        left = left.sort_values("__key", kind="stable")
        found = list(sweep(zip(left["__key"], left["path"], strict=True), sorted(own.items())))
        return left.drop(columns=["__key", "__range", "__salt"]).assign(rule=[r for r, _ in found], verdict=[v or default for _, v in found])

    return rows.groupBy("__range", "__salt").cogroup(entries.groupBy("__range", "__salt")).applyInPandas(one, out).withColumn(id_col, F.col(id_col).cast(id_type))
