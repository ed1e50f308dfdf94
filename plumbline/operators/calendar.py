"""Listing windows, calendars, runs of days and how far a programme can be trusted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HORIZON = 67


def window_days(spark, first: str, days: int = HORIZON) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.date_add(F.lit(first).cast("date"), days - 1))).alias("date"))


def dense_counts(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows a day, zero where there are none."""
    return days.join(rows.groupBy("date").agg(F.count(F.lit(1)).alias("n")), "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("n"))


def islands(days: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of consecutive days: keys, first, last, days."""
    w = W.partitionBy(*keys).orderBy("date")
    d = days.select(*keys, "date").distinct().withColumn("island", F.date_sub(F.col("date"), F.row_number().over(w)))
    return d.groupBy(*keys, "island").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count(F.lit(1)).alias("days")).drop("island")


def days_of(runs: DataFrame, keys: list[str]) -> DataFrame:
    return runs.select(*keys, F.explode(F.sequence("first", "last")).alias("date"))


def published_through(daily: DataFrame, keys: list[str]) -> DataFrame:
    """The end of each programme: the day before the first one under a floor.

    The floor is a fifth of the median of the non-empty days among the first
    seven, one at least.  A first day that was read and is thin passes if the second one does;
    a failed read ends the programme before it, also on the first day.
    daily: keys, date (consecutive), n (null for a failed read).
    """
    w = W.partitionBy(*keys).orderBy("date")
    d = daily.withColumn("i", F.row_number().over(w))
    base = d.filter("i <= 7 and n > 0").groupBy(*keys).agg(F.median("n").alias("median"))
    d = d.join(base, keys, "left").withColumn("ok", F.coalesce(F.col("n") >= F.greatest(F.lit(1.0), F.col("median") * 0.2), F.lit(False)))
    d = d.withColumn("ok", F.col("ok") | ((F.col("i") == 1) & F.col("n").isNotNull() & F.coalesce(F.lead("ok").over(w), F.lit(False))))
    bad = d.groupBy(*keys).agg(F.min(F.when(~F.col("ok"), F.col("date"))).alias("bad"), F.max("date").alias("last"), F.min("date").alias("first"))
    end = F.when(F.col("bad").isNull(), F.col("last")).when(F.col("bad") > F.col("first"), F.date_sub("bad", 1))
    return bad.select(*keys, end.alias("through"))


def spread_through(days: DataFrame, keys: list[str]) -> DataFrame:
    """keys, month, spread: whether a month has rows in each of its first four weeks and in its last seven days."""
    month = days.withColumn("month", F.trunc("date", "month"))
    weeks = F.count_distinct(F.when(F.dayofmonth("date") <= 28, F.floor((F.dayofmonth("date") - 1) / 7))) == 4
    return month.groupBy(*keys, "month").agg((weeks & (F.max("date") > F.date_sub(F.last_day("month"), 7))).alias("spread"))


def month_complete(days: DataFrame, keys: list[str], least_days: int = 14, least: float = 0.6, least_spread: float = 0.4) -> DataFrame:
    """Whether each month is as dense as the 28 days before it; days: keys, date, n.

    Fewer than least_days reference days: not judged and not complete.  A month
    with rows in each of its four weeks and its last seven days may be thinner.
    """
    d = days.groupBy(*keys, "date").agg(F.sum("n").alias("n"))
    month = d.withColumn("month", F.trunc("date", "month"))
    own = month.groupBy(*keys, "month").agg(
        (F.sum("n") / F.dayofmonth(F.last_day("month"))).alias("rate"),
        (F.count_distinct(F.when(F.dayofmonth("date") <= 28, F.floor((F.dayofmonth("date") - 1) / 7))) == 4).alias("weeks"),
        (F.max("date") > F.date_sub(F.last_day("month"), 7)).alias("end"),
    )
    # a day is in the 28 days before the first of its next month at most
    ref = d.withColumn("month", F.add_months(F.trunc("date", "month"), 1)).filter(F.col("date") >= F.date_sub("month", 28))
    ref = ref.groupBy(*keys, "month").agg((F.sum("n") / 28).alias("ref_rate"), F.count(F.lit(1)).alias("ref_days"))
    spread = F.col("weeks") & F.col("end")
    enough = (F.col("rate") >= least * F.col("ref_rate")) | (spread & (F.col("rate") >= least_spread * F.col("ref_rate")))
    out = own.join(ref, [*keys, "month"], "left")
    return out.select(*keys, "month", spread.alias("spread"), F.coalesce((F.col("ref_days") >= least_days) & enough, F.lit(False)).alias("complete"))


def regular_stages(days: DataFrame, end: str, keys: list[str]) -> DataFrame:
    """Keys with rows in three of the four weeks before end, on two days at least."""
    week = F.floor((F.datediff(F.lit(end).cast("date"), F.col("date")) - 1) / 7)
    d = days.filter((F.col("date") < F.lit(end).cast("date")) & (F.col("date") >= F.date_sub(F.lit(end).cast("date"), 28)))
    return d.groupBy(*keys).agg(F.count_distinct(week).alias("weeks"), F.count_distinct("date").alias("n_days")).filter("weeks >= 3 and n_days >= 2")


def keep_policy(state: DataFrame, today: str, most: int = 14) -> DataFrame:
    """Age of what a source keeps, from its last good read or first failure, and whether it expired."""
    since = F.coalesce("last_ok", "failing_since", F.lit(today).cast("date"))
    age = F.datediff(F.lit(today).cast("date"), since)
    return state.withColumn("age", age.cast("long")).withColumn("expired", age > most)
