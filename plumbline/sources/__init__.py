"""Readers of state files, embedded constants and other untrusted input."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_sidecar(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON lines file; a missing path is an empty table, a broken line a null row."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def sanitised(rows: DataFrame, key: str, rules: dict[str, str], entry: str = "true") -> tuple[DataFrame, DataFrame]:
    """(rows with malformed parts nulled, what was dropped: key and part).

    rules: an SQL test by column; null is well-formed.  A row that fails the entry test goes as a whole.
    """
    whole = F.coalesce(F.expr(entry), F.lit(False))
    bad = {c: F.col(c).isNotNull() & ~F.coalesce(F.expr(test), F.lit(False)) for c, test in rules.items()}
    parts = F.when(~whole, F.array(F.lit("entry"))).otherwise(F.filter(F.array(*[F.when(b, c) for c, b in bad.items()]), lambda x: x.isNotNull()))
    d = rows.withColumn("__dropped", parts)
    clean = d.filter(whole).select(*[F.when(~bad[c], F.col(c)).alias(c) if c in bad else F.col(c) for c in rows.columns])
    return clean, d.select(key, F.explode("__dropped").alias("part"))


def json_sidecar(texts: DataFrame, column: str, schema: str) -> DataFrame:
    """The object in each text; what isn't one, or can't be read, is an empty object."""
    return texts.withColumn("value", F.coalesce(F.from_json(column, schema, {"mode": "PERMISSIVE"}), F.from_json(F.lit("{}"), schema)))


def write_table(rows: DataFrame, path: str, order: list[str]) -> DataFrame:
    """rows, ordered at the sink alone, in place of the table at path; a reader sees the old files or the new ones.

    The file-commit protocol writes beside the table and moves when all tasks are done; the result is read back.
    """
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


_COMMENT = re.compile(r'("(?:[^"\\]|\\.)*"|\'(?:[^\'\\]|\\.)*\')|//[^\n]*|/\*.*?\*/', re.S)
_TRAILING = re.compile(r'("(?:[^"\\]|\\.)*")|,(?=\s*[\]}])', re.S)


def constant(text: str | None, name: str) -> list | None:
    """The value of ``const name = [...]`` in a script; brackets in strings don't count."""
    m = re.search(rf"\b(?:const|let|var)\s+{re.escape(name)}\s*=\s*\[", text or "")
    if not m:
        return None
    body = _COMMENT.sub(lambda x: x[1] or "", text[m.end() - 1 :])
    depth, quote, i = 0, "", 0
    while i < len(body):
        c = body[i]
        if quote:
            i += c == "\\"
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
            if not depth:
                break
        i += 1
    try:
        return json.loads(_TRAILING.sub(lambda x: x[1] or "", body[: i + 1]))
    except ValueError:
        return None


def embedded_rows(scripts: DataFrame, column: str, name: str) -> DataFrame:
    """Rows of the constant as arrays of JSON texts, one row each."""

    @F.pandas_udf("array<array<string>>")
    def rows(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> list[list[str]]:
            return [[x if isinstance(x, str) else json.dumps(x) for x in r] for r in constant(t, name) or [] if isinstance(r, list)]

        return texts.map(one)

    return scripts.select(F.explode(rows(column)).alias("row"))
