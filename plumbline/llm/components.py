"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm._shared import materialize, parts, release

#: rows of a task at least, whatever the session's number of partitions
TASK_ROWS, LEAST_TASKS = 100_000, 6


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of edges (a, b).

    Each round hangs neighbours under the smallest node known to them; the
    number of rounds grows with the logarithm of the longest path, and they go on
    until nothing changes.  Edges of a
    node that many others hang from are split by Spark's skew join: the other
    side of every join has one row a node.
    """
    e, before = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()), None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, n = now, max(LEAST_TASKS, parts(now[0], TASK_ROWS))
        # large star: larger neighbours of u go under the smallest node u knows
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(n)
        large = both.join(least, "u").coalesce(n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(n)
        # small star: u and its smaller neighbours go under the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(n)
        small = large.join(least, "u").coalesce(n).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, e = e, materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().coalesce(n))
        release(old)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
