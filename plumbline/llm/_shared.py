"""Tables between stages, row counts and the settings that follow from them."""

from __future__ import annotations

import atexit
import math
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: list = []


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where a local session names none (tests) a temporary folder is set; on a
    cluster that would be another folder on every machine, so it is an error.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("plumbline.work.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("plumbline.work.dir", path)
    return path.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
    except Exception:  # the session is gone, and its folder with it
        pass


def materialize(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    The shuffle files of the write go when it is done, as nothing else reads
    them.  Removed by release(), or when the driver's process ends.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/plumbline/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    _made.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._plumbline_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Remove tables of materialize() that nothing reads any more."""
    for t in tables:
        path = t.__dict__.pop("_plumbline_path", None)
        if path:
            _made.remove((t.sparkSession, path))
            _remove(t.sparkSession, path)


def discard_all() -> None:
    while _made:
        _remove(*_made.pop())


atexit.register(discard_all)


#: partitions of a shuffle at most; beyond it a task works through several parts, one after the other
MOST_TASKS = 1 << 15


def parts(rows: int, per_part: int, most: int = 1 << 16) -> int:
    """Partitions of about per_part rows each."""
    return max(1, min(most, math.ceil(rows / per_part)))


def slices(batches: Iterator[pd.DataFrame], rows: int = 1024) -> Iterator[pd.DataFrame]:
    """Batches in parts of so many rows, which bounds what a worker makes of them at once."""
    for b in batches:
        for lo in range(0, len(b), rows):
            yield b.iloc[lo : lo + rows].reset_index(drop=True)


def by_key(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """(key, its rows), one key in memory at a time, of batches that come sorted by keys."""
    held: list[pd.DataFrame] = []
    now: tuple | None = None
    for b in batches:
        if not len(b):
            continue
        k = b[keys].to_numpy()
        edge = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1), len(b)]
        for lo, hi in zip(edge, edge[1:], strict=False):
            key = tuple(k[lo])
            if held and key != now:
                yield now, pd.concat(held, ignore_index=True)
                held = []
            now = key
            held.append(b.iloc[lo:hi])
    if held:
        yield now, pd.concat(held, ignore_index=True)


def text_of(name: str) -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
