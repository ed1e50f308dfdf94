"""Components and redirects by loops of joins over written tables."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session without one gets a temporary folder."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("plumbline.shared.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("plumbline.shared.dir", path)
    return path.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df from a table in the shared folder, which cuts its lineage: a lost executor costs a re-read.

    Removed when the driver's process ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/plumbline-cut/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly over all cores, for rows that are few in bytes and costly to clean: a small file is one task otherwise."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def large(df: DataFrame) -> DataFrame:
    """df as a side of its next join that is never broadcast: Spark goes by the bytes in files, which are a small part of those in the driver."""
    return df.hint("merge")


def _discard() -> None:
    while _made:
        spark, path = _made.pop()
        try:
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
        except Exception:  # the session is gone, and its folder with it
            pass


atexit.register(_discard)


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable; nodes without an edge to another are left out.

    Every round hangs each node's larger neighbours, then itself, under the
    smallest node it knows, which halves paths; rounds go on until nothing changes.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*e.columns).cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v")).distinct()
        before = now
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        e = cut(large.join(least, "u").filter("v <> m").select("v", "m").union(least).distinct().toDF("u", "v"))


def redirects(moves: DataFrame) -> DataFrame:
    """old, final: where each redirect ends, by pointer doubling; one that runs into a cycle ends at the cycle's smallest id."""
    d = cut(moves.select("old", F.col("into").alias("final"), F.col("into").alias("low")))
    reach, rows = 1, d.count()
    while True:
        nxt = d.select(F.col("old").alias("final"), F.col("final").alias("f2"), F.col("low").alias("l2"))
        d = cut(d.select("old", "final", "low").join(nxt, "final", "left").select("old", F.coalesce("f2", "final").alias("final"), F.least("low", F.coalesce("l2", "low")).alias("low"), F.col("f2").isNotNull().alias("on")))
        if d.filter("on").isEmpty():
            return d.select("old", "final")
        reach *= 2
        if reach > rows:
            break
    # what still moves after as many steps as there are redirects goes round
    return d.select("old", F.when(F.col("on"), F.col("low")).otherwise(F.col("final")).alias("final"))
