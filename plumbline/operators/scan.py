"""Running totals and ranks over an order, without a window that holds a whole group.

Rows are range-partitioned by group and order and written once, so that their
partitions stay what they are; totals by partition and group are few rows, and each
partition then adds what comes before it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.operators.graph import cut


def running(rows: DataFrame, group: list[str], order: list[Column], size: str | None = None) -> DataFrame:
    """rows with ``rank`` (from 1) and, of the column size, ``total`` up to and with the row."""
    by = [F.col(c) for c in group]
    d = cut(rows.repartitionByRange(*by, *order).withColumn("__part", F.spark_partition_id()))
    value = F.coalesce(F.col(size), F.lit(0)) if size else F.lit(0)
    parts = d.groupBy("__part", *group).agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__s"))
    before = W.partitionBy(*group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("__part", *group, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n"), F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__s"))
    same = (F.col("a.__part") == F.col("b.__part"))
    for c in group:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    d = d.alias("a").join(parts.alias("b"), same).select("a.*", "b.__n", "b.__s")
    w = W.partitionBy("__part", *group).orderBy(*order)
    d = d.withColumn("rank", (F.col("__n") + F.row_number().over(w)).cast("long"))
    if size:
        d = d.withColumn("total", F.col("__s") + F.sum(value).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return d.drop("__part", "__n", "__s")


def _starts(sizes: list[int], entry: int, most_rows: int, most_size: int) -> tuple[list[int], int, int, int]:
    """(batch starts from row entry on, rows and size held at the end) of next-fit."""
    starts, held, total = [], 0, 0
    for i in range(entry, len(sizes)):
        if not starts or held == most_rows or total + sizes[i] > most_size:
            starts.append(i)
            held, total = 0, 0
        held, total = held + 1, total + sizes[i]
    return starts, held, total, len(starts)


def next_fit(rows: DataFrame, group: str, order: str, size: str, most_rows: int, most_size: int, segment: int = 100_000) -> DataFrame:
    """group, order, size, batch: batches of consecutive rows, by count and size; a row that is too large has its own.

    A group is cut into segments.  A batch that runs over a segment's end leaves the next one fewer than most_rows
    possible entries, so each segment is walked from all of them; chaining the segments then
    picks the entry that is taken.  A group is only ever in one task as a few numbers a segment.
    """
    d = running(rows.select(group, order, size), [group], [F.col(order)])
    kinds = dict(d.dtypes)
    d = cut(d.withColumn("seg", F.floor((F.col("rank") - 1) / segment).cast("long")))
    # the rows behind a segment that its last batch may still take
    tail = d.filter((F.col("seg") > 0) & ((F.col("rank") - 1) % segment < most_rows - 1)).withColumn("seg", F.col("seg") - 1)
    both = d.withColumn("own", F.lit(True)).unionByName(tail.withColumn("own", F.lit(False)))

    def walk(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("rank", ignore_index=True)
        sizes, n = x[size].fillna(0).tolist(), int(x["own"].sum())
        out = []
        for entry in range(min(most_rows, n) if x["seg"].iloc[0] else 1):
            starts = _starts(sizes, entry, most_rows, most_size)[0]
            inside = [s for s in starts if s < n]
            # the first batch that begins behind the segment's own rows
            leave = next((s - n for s in starts if s >= n), None)
            if leave is None:
                leave = len(sizes) - n
            out.append((x[group].iloc[0], x["seg"].iloc[0], entry, leave, len(inside)))
        return pd.DataFrame(out, columns=[group, "seg", "entry", "leave", "batches"])

    steps = both.groupBy(group, "seg").applyInPandas(walk, f"`{group}` {kinds[group]}, seg long, entry int, leave int, batches long")

    def chain(x: pd.DataFrame) -> pd.DataFrame:
        table = {(s, e): (v, k) for s, e, v, k in x[["seg", "entry", "leave", "batches"]].itertuples(index=False)}
        out, entry, first = [], 0, 0
        for s in sorted(set(x["seg"].tolist())):
            out.append((x[group].iloc[0], s, entry, first))
            leave, k = table.get((s, entry), (0, 0))
            entry, first = leave, first + k
        return pd.DataFrame(out, columns=[group, "seg", "entry", "first"])

    entries = steps.groupBy(group).applyInPandas(chain, f"`{group}` {kinds[group]}, seg long, entry int, first long")
    marked = both.join(entries, [group, "seg"])

    def number(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("rank", ignore_index=True)
        entry, first, n = int(x["entry"].iloc[0]), int(x["first"].iloc[0]), int(x["own"].sum())
        starts = _starts(x[size].fillna(0).tolist(), entry, most_rows, most_size)[0]
        batch, at, out = first - 1, 0, []
        for i in range(n):
            if at < len(starts) and starts[at] == i:
                batch, at = batch + 1, at + 1
            out.append(batch)
        return x.iloc[:n][[group, order, size]].assign(batch=out)

    return marked.groupBy(group, "seg").applyInPandas(number, f"`{group}` {kinds[group]}, `{order}` {kinds[order]}, `{size}` {kinds[size]}, batch long")

