"""Incremental state: what is due, budgets, batches and decisions."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.operators.scan import running


def due(state: DataFrame, today: str, recheck: int, retry: int) -> DataFrame:
    """Whether to look again: never looked, changed url, or old enough for its last outcome."""
    age = F.datediff(F.lit(today).cast("date"), F.col("checked"))
    reason = (
        F.when(F.col("checked").isNull(), "never").when(~F.col("url").eqNullSafe(F.col("checked_url")), "changed")
        .when(F.col("ok") & (age >= recheck), "recheck").when(~F.col("ok") & (age >= retry), "retry")
    )
    return state.withColumn("reason", reason).filter("reason is not null")


def budget_prefix(rows: DataFrame, group: str, order: list[Column], size: str, limit: int) -> DataFrame:
    """Rows by order while their sizes fit the group's budget; the first always does."""
    return running(rows, [group], order, size).filter((F.col("total") <= limit) | (F.col("rank") == 1)).drop("rank")


def round_robin(rows: DataFrame, group: str, order: list[str], cap: int) -> DataFrame:
    """At most cap rows a group, with their turn."""
    return rows.withColumn("turn", F.row_number().over(W.partitionBy(group).orderBy(*order))).filter(F.col("turn") <= cap)


def top_n(rows: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(*order))).filter(F.col("rank") <= n)


def missing_from_cache(texts: DataFrame, cache: DataFrame, text: str) -> DataFrame:
    """Distinct texts whose hash isn't cached."""
    return texts.select(F.sha1(F.col(text).cast("binary")).alias("key"), text).groupBy("key").agg(F.first(text).alias(text)).join(cache.select("key"), "key", "left_anti")


def leader_clusters(rows: DataFrame, group: str, order: str, tokens: str, least: int) -> DataFrame:
    """Greedy clusters within a group: a row joins the first leader that shares least tokens, else leads.

    Rows with one token set fare alike, as the first of them does, and a set with fewer than
    least tokens joins nobody; so only the different sets of a group come to one task.
    """
    d = rows.select(group, order, F.array_sort(F.array_distinct(tokens)).alias("t"))
    large = d.filter(F.size("t") >= least)
    first = large.groupBy(group, "t").agg(F.min(order).alias("first"))

    def one(d: pd.DataFrame) -> pd.DataFrame:
        leaders: list[tuple[int, set]] = []
        out = []
        for i, t in d.sort_values("first")[["first", "t"]].itertuples(index=False):
            mine = set(t)
            leader = next((k for k, own in leaders if len(own & mine) >= least), None)
            if leader is None:
                leaders.append((i, mine))
            out.append((d[group].iloc[0], list(t), i if leader is None else leader))
        return pd.DataFrame(out, columns=[group, "t", "leader"])

    kinds = dict(d.dtypes)
    sets = first.groupBy(group).applyInPandas(one, f"`{group}` {kinds[group]}, t {kinds['t']}, leader {kinds[order]}")
    joined = large.join(sets, [group, "t"]).select(group, order, "leader")
    return joined.unionByName(d.filter(F.size("t") < least).select(group, order, F.col(order).alias("leader")))


def override(columns: list[tuple[str, int]]) -> Column:
    """The first of the columns whose text has its least length."""
    return F.coalesce(*[F.when(F.length(F.trim(F.col(c))) >= n, F.trim(F.col(c))) for c, n in columns])


def settle(previous: DataFrame, outcomes: DataFrame, key: str) -> DataFrame:
    """Counters after a run: a success resets misses, a failure adds one, untouched keys stay."""
    d = previous.select(key, "misses", "last_ok").join(outcomes.select(key, "ok", "at"), key, "full")
    misses = F.when(F.col("ok"), 0).when(~F.col("ok"), F.coalesce("misses", F.lit(0)) + 1).otherwise(F.col("misses"))
    return d.select(key, misses.cast("long").alias("misses"), F.when(F.col("ok"), F.col("at")).otherwise(F.col("last_ok")).alias("last_ok"))


