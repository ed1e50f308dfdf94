"""Coverage metrics with causes, by group and in total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """Share in percent to one decimal; 100 for an empty set."""
    return F.when(whole == 0, F.lit(100.0)).otherwise(F.round(100.0 * part / whole, 1))


def coverage(rows: DataFrame, group: str, covered: Column) -> DataFrame:
    """n, covered, missing, pct by group, and for all under a null group."""
    d = rows.rollup(group).agg(F.count(F.lit(1)).alias("n"), F.count_if(covered).alias("covered"))
    return d.select(group, "n", "covered", (F.col("n") - F.col("covered")).alias("missing"), percent(F.col("covered"), F.col("n")).alias("pct"))


def causes(rows: DataFrame, group: str, cause: Column) -> DataFrame:
    """Counts by group and cause with the rank of each cause: most frequent first, then by name."""
    from pyspark.sql import Window as W

    d = rows.select(group, cause.alias("cause")).filter("cause is not null").groupBy(group, "cause").agg(F.count(F.lit(1)).alias("n"))
    return d.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(F.desc("n"), "cause")).cast("long"))


def deduplicated_coverage(rows: DataFrame, external: str, own: str, flags: list[str], group: str) -> DataFrame:
    """Rows with one external id count once; a flag holds if it holds for any of them."""
    key = F.coalesce(F.concat(F.lit("e"), F.col(external).cast("string")), F.concat(F.lit("o"), F.col(own).cast("string")))
    one = rows.groupBy(key.alias("k")).agg(F.min(group).alias(group), *[F.max(F.col(f).cast("int")).alias(f) for f in flags])
    either = F.greatest(*flags) if len(flags) > 1 else F.col(flags[0])
    return one.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.coalesce(f, F.lit(0))).alias(f) for f in flags], F.sum(F.coalesce(either, F.lit(0))).alias("any_source"))


def broken_groups(rows: DataFrame, group: str, good: Column, cause: Column, least: int, parser_causes: list[str]) -> DataFrame:
    """Groups of least rows or more with nothing good whose causes are all the parser's."""
    d = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count_if(good).alias("good"), F.collect_set(cause).alias("causes"))
    d = d.filter((F.col("n") >= least) & (F.col("good") == 0) & (F.size(F.array_except("causes", F.array(*map(F.lit, parser_causes)))) == 0))
    return d.select(group, "n", F.array_join(F.array_sort("causes"), ",").alias("causes"))


def price_range(text: Column, pattern: str = r"([0-9]+)[.,]([0-9]{2}) EUR") -> tuple[Column, Column]:
    """Least and largest amount in a text, in cents."""
    amounts = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.regexp_extract(x, pattern, 1).cast("long") * 100 + F.regexp_extract(x, pattern, 2).cast("long"))
    return F.array_min(amounts), F.array_max(amounts)
