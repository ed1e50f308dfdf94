"""Shards that all match the source mixture, by proportional stratified interleaving.

Rows are shuffled by seeded hash within each source and ranked; row r of a
source with n rows gets the fractional rank (r - 1/2) / n.  Sorting all rows by
fractional rank interleaves the sources in proportion, and cutting that order
into equal runs gives shards whose row counts differ by one at most and whose
mixture is that of the whole table.

No window ever holds a source or a shard: both orders are ranked in buckets of
about ``BUCKET_ROWS`` rows (of the hash, which is uniform, and of the fractional
rank, which is uniform by construction), to which running totals of the bucket
counts are added.  There are ``MOST_BUCKETS`` buckets a source at most, so those
totals stay small however large the table is.

A null source is a source of its own.  Rows with equal ids get ranks in a
fixed order of (hash, id, size, checksum); rows alike in all of these are
interchangeable.  The hash covers id, size and checksum, so rows with one id, or none, are spread too.  An empty table
gives no rows.  Only the named columns are read, so others can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm._shared import parts, text_of

BUCKET_ROWS = 256
MOST_BUCKETS = 1 << 16


def text_size(text_col: str) -> Column:
    """UTF-8 bytes of the text, null as none, plus one."""
    return F.octet_length(text_of(text_col)).cast("long") + 1


def interleave(docs: DataFrame, source_col: str, keys: list[str], hashed: Column, rows: int) -> DataFrame:
    """docs with ``__position``, from 0 to rows - 1, in the interleaved order.

    hashed is a hex string, uniform over rows; keys settle ties.
    """
    n = parts(rows, BUCKET_ROWS, MOST_BUCKETS)
    d = docs.withColumns({
        "__source": F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("")),
        "__hash": hashed,
    })
    d = d.withColumn("__bucket", F.floor(F.conv(F.substring("__hash", 1, 8), 16, 10).cast("long") * n / F.lit(1 << 32)).cast("int"))
    before = W.partitionBy("__source").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = (
        d.groupBy("__source", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
        .withColumns({"__before": F.coalesce(F.sum("__n").over(before), F.lit(0)), "__of": F.sum("__n").over(W.partitionBy("__source"))}).drop("__n")
    )
    order = ["__hash", *keys]
    ranked = d.join(totals, ["__source", "__bucket"]).withColumn("__rank", F.col("__before") + F.row_number().over(W.partitionBy("__source", "__bucket").orderBy(*order)))
    ranked = ranked.withColumn("__part", (F.col("__rank") * 2 - 1) / (F.col("__of") * 2)).withColumn("__slice", F.floor(F.col("__part") * n).cast("int"))
    totals = ranked.groupBy("__slice").agg(F.count(F.lit(1)).alias("__n"))
    # a row a slice, MOST_BUCKETS at most
    totals = totals.select("__slice", F.coalesce(F.sum("__n").over(W.orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__upto"))
    placed = ranked.join(totals, "__slice").withColumn("__position", F.col("__upto") + F.row_number().over(W.partitionBy("__slice").orderBy("__part", "__source", *order)) - 1)
    return placed.drop("__source", "__hash", "__bucket", "__before", "__of", "__rank", "__part", "__slice", "__upto")


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """id, size, text_crc32, shard (0 to shards - 1), slot (gapless from 0), and the columns of carry.

    Law ``rows``: row counts of any two shards differ by one at most.
    """
    rows = docs.count()
    d = docs.select(F.col(id_col), F.col(source_col).alias("__src"), text_size(text_col).alias("size"), F.crc32(F.encode(text_of(text_col), "utf-8")).alias("text_crc32"), *carry)
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.col("size").cast("string"), F.col("text_crc32").cast("string")).cast("binary"))
    placed = interleave(d, "__src", [id_col, "size", "text_crc32"], hashed, rows)
    n = max(rows, 1)
    placed = placed.withColumn("shard", F.expr(f"int(__position * {shards}L div {n}L)"))
    return placed.withColumn("slot", F.expr(f"__position - (shard * {n}L + {shards - 1}L) div {shards}L")).drop("__position", "__src")
