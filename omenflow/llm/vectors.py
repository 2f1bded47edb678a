"""Vectors of floating-point numbers as whole numbers: what the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True where a vector and all its components are there and finite; an empty vector is usable."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def quantised(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component as a long, a negative zero as 0; what a long can't hold becomes its end."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def fitted(df: DataFrame, column: str, dimensions: int, largest: int) -> DataFrame:
    """Vectors filled with zeros to ``dimensions``, as short numbers where ``largest`` allows."""
    kind = "array<smallint>" if largest < 1 << 15 else "array<bigint>"
    filled = F.concat(F.col(column), F.array_repeat(F.lit(0).cast("long"), F.lit(dimensions) - F.size(column)))
    return df.withColumn(column, F.when(F.size(column) < dimensions, filled).otherwise(F.col(column)).cast(kind))


def extent(df: DataFrame, column: str) -> tuple[int, int, int]:
    """Rows, dimensions of the longest vector, and the largest absolute component (0 of an empty table)."""
    most = F.array_max(F.transform(column, lambda x: F.greatest(x, -(x + 1))))  # one less for negative numbers: no overflow
    n, d, m = df.agg(F.count("*"), F.max(F.size(column)), F.max(most)).first()
    return n, d or 0, 0 if m is None else m + 1


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """The rows of an Arrow list column of ``dimensions`` numbers each, as longs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dimensions)
