"""What the vector operators share: which vectors count, whole-number components, and vectors of
an Arrow batch as one array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rows of an array that are worked on at once take about so many bytes.
WORK_BYTES = 16 << 20


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds neither NULL nor NaN nor infinity. Never NULL."""
    number = vector.cast("array<double>")
    good = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good, F.lit(False))


def floors(vector: Column, scale: int, most: int) -> Column:
    """Each component times ``scale``, rounded down, as a whole number. One above ``most`` either
    way stops the query: sums and squares of it would not be exact."""
    def whole(x):
        scaled = x * F.lit(float(scale))
        return F.when(F.abs(scaled) <= float(most), F.floor(scaled).cast("bigint")).otherwise(
            F.raise_error(F.lit("a component is too large for exact sums of squares")))

    return F.transform(vector.cast("array<double>"), whole)


def lengths(column: pa.Array) -> np.ndarray:
    return np.diff(column.offsets.to_numpy())


def matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    """A row per vector; shorter ones are filled up with zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    n = len(column)
    if len(values) == n * width:
        return values.reshape(n, width)
    size = lengths(column)
    out = np.zeros((n, width), dtype)
    out[np.arange(width) < size[:, None]] = values
    return out
