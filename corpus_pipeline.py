"""Documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept.  All but the last return the columns of documents; their rows are written
as Parquet and read again in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontamination, jaccard, language, packing, secrets
from plumbline.llm._shared import materialize

#: share of a text's n-grams that its best language must contain
LEAST_LANGUAGE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the filters know; texts that are null, without letters or in none of them go."""
    named = language.identify(docs, ~language.held_out())
    return named.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE)).select(*docs.columns)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the smallest id's, of equal ids one; rows with equal id and text are one row."""
    return jaccard.without_duplicates(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced; n_chars follows the text."""
    _, ledger = secrets.scan_versions(docs)
    hits = ledger.filter(F.col("findings").isNotNull()).select(F.col("blob").alias("__blob"), F.col("findings").alias("__findings"))
    found = docs.withColumn("__blob", secrets.blob_id(F.coalesce("text", F.lit("")))).join(hits, "__blob", "left")
    clean = secrets.redact(F.col("text"), F.col("__findings"))
    changed = {"text": F.when(F.col("__findings").isNull(), F.col("text")).otherwise(clean)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("__findings").isNull(), F.col("n_chars")).otherwise(F.length(clean).cast(docs.schema["n_chars"].dataType))
    return found.withColumns(changed).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and their place in sequences of 1024 tokens."""
    return packing.pack_documents(docs, capacity=1024, end_id=2)


STAGES = [
    ("language", language_stage),
    ("near duplicates", duplicate_stage),
    ("benchmark leaks", leak_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
