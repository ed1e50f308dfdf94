"""Secret scans with an incremental ledger of blobs.

Every text version is addressed by the SHA-256 of its bytes.  The ledger holds
the pairs (blob, rule version) that were scanned; a run scans each blob of the
input that lacks its pair, once however many rows hold it, and joins old and new
findings back to all rows.  A second run over the same texts scans nothing.

Spans come from built-in functions only: splitting a text at a rule's matches
and extracting the matches gives parts and matches in turn, whose lengths add up
to positions.  Offsets are code points, ends exclusive.  Matches are leftmost
and don't overlap within a rule; a match whose tested part is too short is
dropped, together with the text it covers.

Null texts are empty texts and hold nothing.  Repeated rows each get the
findings of their blob; null ids are kept as they are.  Blobs of a third of all rows are
collapsed before the shuffle that brings equal blobs together, and the join back
has one row a blob on its other side, so Spark can split a hot one.  An empty
table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm._shared import materialize, text_of


@dataclass(frozen=True)
class Rule:
    """A kind of secret; group least characters of a match's group must hold."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE = (
    Rule("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: What the scan knows beyond the base kinds.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("ghtoken", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = (*BASE, *MORE)
RULE_VERSION = "2"
FINDING = "array<struct<start:int,ord:int,kind:string,end:int>>"


def blob_id(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def spans_of(text: str, rule: Rule, order: int) -> Column:
    """Spans of a rule in the column named text, in order of their start."""
    pattern = F.lit(rule.pattern)
    hits, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern, -1)
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    step = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {FINDING})").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        out = F.when(F.length(x["tested"]) >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    # a text with m matches has m + 1 gaps; the last has no match after it
    rows = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), tested.alias("tested"))
    found = F.aggregate(F.filter(rows, lambda x: x["hit"].isNotNull()), step, add, lambda acc: acc["out"])
    return F.when(F.rlike(F.col(text), pattern), found).otherwise(F.expr(f"cast(array() as {FINDING})"))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """blobs without the text, with ``findings``: spans of all rules by start, then rule order."""
    each = {f"__r{i}": spans_of(text_col, r, i) for i, r in enumerate(rules)}
    return blobs.withColumns(each).withColumn("findings", F.array_sort(F.concat(*each))).drop(text_col, *each)


def scan_versions(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(findings, ledger): id_col, blob and findings for each row of docs; the ledger with the new pairs.

    ledger: blob, rule_version, findings (null where there are none), as an
    earlier call returned it; None for a first run.
    """
    rows = docs.select(F.col(id_col), text_of(text_col).alias("__text")).withColumn("blob", blob_id(F.col("__text")))
    texts = rows.select("blob", "__text")
    if ledger is not None:
        texts = texts.join(ledger.filter(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    blobs = texts.groupBy("blob").agg(F.first("__text").alias("__text"))
    scanned = scan_blobs(blobs, rules, "__text")
    fresh = materialize(scanned.select("blob", F.lit(rule_version).alias("rule_version"), F.when(F.size("findings") > 0, F.col("findings")).alias("findings")))
    grown = fresh if ledger is None else ledger.unionByName(fresh)
    hits = grown.filter((F.col("rule_version") == rule_version) & F.col("findings").isNotNull()).select("blob", "findings")
    return rows.drop("__text").join(hits, "blob", "left"), grown


def redact(text: Column, findings: Column, mask: str = "[SECRET]") -> Column:
    """text with every span replaced; overlapping spans are replaced once."""
    step = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mask))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(findings, step, add)
    return F.when(F.size(findings) > 0, F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))).otherwise(text)
