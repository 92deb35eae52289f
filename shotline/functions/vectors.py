"""Vector functions on array columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dot(a: Column, b: Column) -> Column:
    """In double precision; both sides are cast before they are multiplied."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm2(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Null if either side has no direction."""
    return F.try_divide(dot(a, b), norm2(a) * norm2(b))


def literal(vector) -> Column:
    return F.array(*(F.lit(float(x)) for x in vector))


def normalised(a: Column) -> Column:
    n = norm2(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n))


def is_unit(a: Column, slack: float = 1.1e-4) -> Column:
    finite = ~F.exists(a, lambda x: x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf")))
    return F.coalesce(finite & (F.abs(norm2(a) - 1) <= slack), F.lit(False))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def perceptual_hash(pixels: np.ndarray) -> int:
    """64 bits of a 32 x 32 grey image: which of the lowest 8 x 8 cosine terms exceed the median of those off the edges."""
    n = 32
    k = np.arange(n)
    basis = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n))
    low = (basis @ np.asarray(pixels, float).reshape(n, n) @ basis.T)[:8, :8]
    bits = (low > np.median(low[1:, 1:])).reshape(-1)
    value = int.from_bytes(np.packbits(bits).tobytes(), "big")
    return value - (1 << 64) if value >> 63 else value


@F.pandas_udf(T.LongType())
def phash(pixels: pd.Series) -> pd.Series:
    """``perceptual_hash`` of arrays of 1024 grey values; null where there are not that many."""
    return pd.Series([perceptual_hash(np.array(p)) if p is not None and len(p) == 1024 else None for p in pixels], dtype="Int64")


@F.pandas_udf(T.DoubleType())
def laplacian_variance(pixels: pd.Series, width: pd.Series) -> pd.Series:
    """Sharpness of a grey image given as rows of ``width`` values."""
    out = []
    for p, w in zip(pixels, width, strict=True):
        x = np.pad(np.asarray(p, np.float32).reshape(-1, w), 1, mode="reflect")
        out.append(float((x[:-2, 1:-1] + x[2:, 1:-1] + x[1:-1, :-2] + x[1:-1, 2:] - 4 * x[1:-1, 1:-1]).var()))
    return pd.Series(out)
