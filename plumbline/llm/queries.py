"""One query an operator, over whole tables, and the SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontamination, jaccard, language, licenses, oracles, packing, quality, repeats, secrets, sharding, url_rules

URL_RULES: tuple[url_rules.Rule, ...] = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), capacity=1024, end_id=2, with_ids=False)


def op2_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality.judge_quality(_table(spark, sf_dir, "documents"))
    return d.withColumns({c: F.round(c, 4) for c in ("js_classes", "js_common")})


def op3_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=16, seed=20)
    return d.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def _spans(findings, kinds: tuple[str, ...] = ()):
    own = F.filter(findings, lambda x: x["kind"].isin(*kinds)) if kinds else findings
    return F.array_join(F.transform(own, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op5_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets.scan_versions(_table(spark, sf_dir, "documents"))
    d = found.withColumn("findings", F.coalesce("findings", F.expr(f"cast(array() as {secrets.FINDING})")))
    kinds = tuple(r.kind for r in secrets.BASE)
    counts = [F.expr(f"bigint(size(filter(findings, x -> x.kind = '{k}')))").alias(f"n_{k}") for k in kinds]
    return d.select("doc_id", *counts, F.sha2(_spans(F.col("findings"), kinds).cast("binary"), 256).alias("base_sha256"), _spans(F.col("findings")).alias("spans"))


def op6_url_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op7_fragment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(_table(spark, sf_dir, "documents"))


def op8_language_bitmasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = language.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), ~language.held_out())
    return d.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_template_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_sum_of_squares, op2_divergence_rules, op3_interleaved_shards, op4_patience_licenses, op5_blob_ledger, op6_url_intervals, op7_fragment_join, op8_language_bitmasks, op9_repeated_bytes, op10_template_windows)}

ORACLES: dict[str, str] = {
    "op2_divergence_rules": oracles.quality_sql(),
    "op3_interleaved_shards": oracles.SHARDS,
    "op5_blob_ledger": oracles.secrets_sql(),
    "op6_url_intervals": oracles.urls_sql(URL_RULES),
    "op7_fragment_join": oracles.JACCARD,
    "op9_repeated_bytes": oracles.REPEATS,
}
