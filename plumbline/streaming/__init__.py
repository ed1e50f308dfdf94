"""Windowed counts over an event stream, and a keyed state with expiry."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.graph import shared_folder


def events_stream(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """The files of a Parquet table as a stream, so many at a time."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name if files is None else "*.parquet")
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(folder if files is None else path)


def windowed_counts(events: DataFrame, ts: str, group: str, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts and sums by tumbling window and group; rows later than the watermark are dropped."""
    e = events.withColumn("__ts", F.col(ts).cast("timestamp"))
    d = e.withWatermark("__ts", late).groupBy(F.window("__ts", width), group).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return d.select(F.col("window.start").cast("date").alias("day"), group, "n", "total")


def run_to_table(stream: DataFrame, keys: list[str], folder: str | None = None) -> DataFrame:
    """All that is there now, run through the stream into Parquet files, the last version of each key.

    Every batch is written by its number, so one that is repeated after a failure replaces itself.
    """
    spark = stream.sparkSession
    folder = folder or f"{shared_folder(spark)}/plumbline-stream/{uuid.uuid4().hex}"
    schema = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/version={number}")

    q = stream.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    rows = spark.read.schema(schema.add("version", "long")).parquet(f"{folder}/rows")
    rest = [f.name for f in schema if f.name not in (*keys, "version")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("x")).select(*keys, "x.*")
