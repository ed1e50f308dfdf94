"""Set comparison, snapshot differences and the checks that gate a publication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, key: list[str], value: str, read: DataFrame, read_key: str) -> DataFrame:
    """Keys added, changed or removed; removed only for entities that were read this run."""
    a, b = old.select(*key, F.col(value).alias("old"), F.lit(1).alias("x")), new.select(*key, F.col(value).alias("new"), F.lit(1).alias("y"))
    d = a.join(b, key, "full").join(read.select(read_key, F.lit(1).alias("seen")).distinct(), read_key, "left")
    change = F.when(F.col("x").isNull(), "added").when(F.col("y").isNull(), F.when(F.col("seen") == 1, "removed")).when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return d.select(*key, "old", "new", change.alias("change")).filter("change is not null")


def set_difference(wanted: DataFrame, written: DataFrame, by: list[str]) -> DataFrame:
    """How many rows are missing and how many are extra, by group; no row where both are equal."""
    both = wanted.exceptAll(written).withColumn("missing", F.lit(1)).withColumn("extra", F.lit(0))
    both = both.unionByName(written.exceptAll(wanted).withColumn("missing", F.lit(0)).withColumn("extra", F.lit(1)))
    return both.groupBy(*by).agg(F.sum("missing").alias("missing"), F.sum("extra").alias("extra"))


def implausible_drops(old: DataFrame, new: DataFrame, key: str, least: float = 0.25) -> DataFrame:
    """Keys whose rate (n / days) fell under a share of the last run's."""
    a = old.select(key, (F.col("n") / F.col("days")).alias("before"))
    b = new.select(key, (F.col("n") / F.col("days")).alias("now"))
    return a.join(b, key, "left").select(key, "before", F.coalesce("now", F.lit(0.0)).alias("now")).filter(F.col("now") < least * F.col("before"))


def integrity(children: DataFrame, child_key: str, parents: DataFrame, parent_key: str, name: str) -> DataFrame:
    """One row: orphans among children, duplicate parent keys, rows of children."""
    keys = parents.select(F.col(parent_key).alias("k"))
    twice = keys.groupBy("k").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    known = keys.distinct().withColumn("known", F.lit(1))
    lost = children.select(F.col(child_key).alias("k")).join(known, "k", "left").agg(F.count_if(F.col("known").isNull()).alias("orphans"), F.count(F.lit(1)).alias("n_rows"))
    return lost.join(twice).select(F.lit(name).alias("check_name"), "orphans", "duplicates", "n_rows")


def health_report(venues: DataFrame, low: float = 0.25) -> DataFrame:
    """Ranked messages by venue from now, prev and status: unreachable, emptied, low, preliminary."""
    rules = [
        (F.col("status") == "unreachable", "error", "unreachable", 0),
        ((F.col("now") == 0) & (F.col("prev") > 0), "error", "emptied", 1),
        ((F.col("now") > 0) & (F.col("now") < low * F.col("prev")), "warning", "low count", 2),
        (F.col("status") == "preliminary", "warning", "preliminary", 3),
    ]
    each = F.array(*[F.when(c, F.struct(F.lit(r).alias("rank"), F.lit(level).alias("level"), F.lit(m).alias("message"))) for c, level, m, r in rules])
    return venues.select("venue", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x")).select("venue", "x.*")


def lost_scores(old: DataFrame, new: DataFrame, key: str, group: str, score: str, least: int = 3) -> DataFrame:
    """Groups in which least keys or more had a score and have none now."""
    a = old.filter(F.col(score).isNotNull()).select(key, group)
    b = new.select(key, F.col(score).alias("now"))
    return a.join(b, key, "left").filter("now is null").groupBy(group).agg(F.count(F.lit(1)).alias("lost")).filter(F.col("lost") >= least)


def coverage_gate(metrics: DataFrame, floor: float = 90.0, bar: float = 95.0, collapse: float = 15.0, drift: float = 3.0) -> DataFrame:
    """Verdict on pct against its baseline: fail under the floor or on collapse, warn under the bar or on drift."""
    verdict = (
        F.when(F.col("pct") < floor, "fail: floor").when(F.col("baseline") - F.col("pct") >= collapse, "fail: collapse")
        .when(F.col("pct") < bar, "warn: bar").when(F.col("baseline") - F.col("pct") >= drift, "warn: drift").otherwise("ok")
    )
    return metrics.withColumn("verdict", verdict)
