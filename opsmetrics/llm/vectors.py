"""Integer vectors: which vectors take part, and their components as integers.

A vector takes part if it has the common length, no null or non-finite
component and, so that squared lengths, distances and inner products of
its integers fit 64 bits, a squared integer length below 2**60.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
LONGEST = float(1 << 60)  # squared integer length
CHUNK_ROWS = 1 << 16  # vectors that a Python task works on at once


def common_length(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", multiple: int = 1) -> int:
    """The length of the vector with the smallest key, among those of a positive multiple of ``multiple``; 0 if there is none."""
    size = F.size(column)
    fits = vectors.filter(F.col(column).isNotNull() & (size > 0) & (size % multiple == 0) & finite(F.col(column)))
    found = fits.agg(F.min_by(size, key).alias("by_key"), F.max(size).alias("any")).first()
    return found["by_key"] or found["any"] or 0


def finite(vector: Column) -> Column:
    """No null, no NaN, no infinity, and not too long: a sum of squares shows all four."""
    part = lambda x: F.coalesce(x.cast("double"), F.lit(float("nan"))) * float(SCALE)
    return F.aggregate(vector, F.lit(0.0), lambda a, x: a + part(x) * part(x)) < LONGEST


def taking_part(vectors: DataFrame, length: int, column: str = "embedding") -> DataFrame:
    return vectors.filter(F.col(column).isNotNull() & (F.size(column) == length) & finite(F.col(column)))


def integers(column: pa.Array) -> np.ndarray:
    """floor(256 x) of a batch's list column, one row for each vector."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * values).astype(np.int64).reshape(len(column), -1)


def chunks(batches, rows: int = CHUNK_ROWS):
    """Arrow batches put together to about ``rows`` rows."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += len(b)
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
