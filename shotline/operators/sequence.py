"""Operators over rows in order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def steepness(value: str, key: list[str], order: list[str]) -> Column:
    """Relative change from the row before; 0 at the first."""
    before = F.lag(value).over(Window.partitionBy(*key).orderBy(*order))
    return F.coalesce(F.abs(F.col(value) - before) / F.greatest(before, F.lit(1.0)), F.lit(0.0))


def moving_average(value: Column, key: list[str], order: list[str], size: int = 3) -> Column:
    """Mean of the ``size`` rows around a row, fewer at the ends."""
    return F.avg(value).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(-(size // 2), size // 2))


def candidates(rows: DataFrame, key: list[str], order: str, score: str, ratio: float = 0.02) -> DataFrame:
    """Per key its first row and the rows of the highest scores, ``max(1, int(n * ratio))`` of them; of equal scores the later row."""
    w = Window.partitionBy(*key)
    rank = F.row_number().over(w.orderBy(F.desc(score), F.desc(order)))
    most = F.greatest(F.lit(1), (F.count("*").over(w) * F.lit(ratio)).cast("int"))
    first = F.row_number().over(w.orderBy(order))
    marked = rows.withColumns({"_r": rank, "_k": most, "_f": first})
    return marked.where("_r <= _k or _f = 1").drop("_r", "_k", "_f")


def keep_last(rows: DataFrame, key: list[str], order: list[str], vector: str, threshold: float = 0.9) -> DataFrame:
    """``rows`` with ``similarity`` to the last kept row of the key (-1 at the first) and ``kept``: whether it is below the threshold.

    Each decision hangs on the one before it, so a key's rows go through one task in order;
    they stream through it in Arrow batches, and only the last kept vector is held.
    """
    cols = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("similarity", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, last = None, None
        for pdf in frames:
            sims, kept = [], []
            for k, v in zip(pdf[key].itertuples(index=False, name=None), pdf[vector], strict=True):
                v = np.asarray(v, np.float64)
                s = -1.0 if k != at else float(np.dot(last, v))
                keep = s < threshold
                if keep:
                    at, last = k, v
                sims.append(s)
                kept.append(keep)
            yield pdf.assign(similarity=sims, kept=kept)

    return rows.repartition(*key).sortWithinPartitions(*key, *order).select(*cols).mapInPandas(run, schema)


def reuse_similar(rows: DataFrame, key: list[str], order: list[str], bits: str, distance: int = 8) -> DataFrame:
    """``rows`` with ``anchor``: the order value of the last row that was processed itself, which a row within ``distance`` bits of it reuses."""
    schema = T.StructType([*rows.schema.fields, T.StructField("anchor", T.LongType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, last, anchor = None, 0, 0
        for pdf in frames:
            out = []
            for k, o, h in zip(pdf[key].itertuples(index=False, name=None), pdf[order[0]], pdf[bits], strict=True):
                if k != at or ((last ^ int(h)) & (1 << 64) - 1).bit_count() > distance:
                    at, last, anchor = k, int(h), int(o)
                out.append(anchor)
            yield pdf.assign(anchor=out)

    return rows.repartition(*key).sortWithinPartitions(*key, *order).mapInPandas(run, schema)


def equal_runs(rows: DataFrame, key: list[str], order: list[str], value: str, joins: Column | None = None) -> DataFrame:
    """``rows`` with the number ``run`` of their run of equal values, and whether a row leads it; values where ``joins`` is false stand alone."""
    w = Window.partitionBy(*key).orderBy(*order)
    same = F.col(value).eqNullSafe(F.lag(value).over(w)) & F.lag(F.lit(1), 1, 0).over(w).cast("boolean")
    if joins is not None:
        same = same & joins
    marked = rows.withColumn("leads", ~same)
    return marked.withColumn("run", F.sum(F.col("leads").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def carry_forward(value: Column, key: list[str], order: list[str]) -> Column:
    """The last value that is not null."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def numbered(key: list[str], order: list[str], first: int = 1) -> Column:
    return F.row_number().over(Window.partitionBy(*key).orderBy(*order)) + (first - 1)


def stride(rows: DataFrame, key: list[str], order: list[str], step: int) -> DataFrame:
    """Each ``step``-th row, the first one included."""
    return rows.withColumn("_n", numbered(key, order, 0)).where(F.col("_n") % step == 0).drop("_n")
