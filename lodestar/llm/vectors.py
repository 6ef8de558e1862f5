"""Clean vectors of a table, and their components as numpy rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scaled components are held to this magnitude, so that sums of squares stay exact in 64 bits.
LARGEST = 1 << 24


def clean(df: DataFrame, key: str, vector: str, *more: str) -> DataFrame:
    """(k, v, m0, m1, ...): the rows whose vector has components, all of them finite numbers."""
    rows = df.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"),
                     *[F.col(c).alias(f"m{i}") for i, c in enumerate(more)])
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return rows.where((F.size("v") > 0) & finite)


def smallest(rows: DataFrame, many: int) -> tuple[int, list[list[float]]]:
    """The length of the vector with the smallest key, and the first ``many`` vectors of that length.

    Order: key (null last), then the vector's components.
    """
    first = [r.v for r in rows.orderBy(F.col("k").asc_nulls_last(), "v").limit(many).select("v").collect()]
    if first and any(len(v) != len(first[0]) for v in first):
        same = rows.where(F.size("v") == len(first[0]))
        first = [r.v for r in same.orderBy(F.col("k").asc_nulls_last(), "v").limit(many).select("v").collect()]
    return (len(first[0]) if first else 0), first


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The rows of a list column whose lists all have ``size`` components."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) as integers."""
    return np.clip(np.floor(values * scale), -LARGEST, LARGEST).astype(np.int64)
