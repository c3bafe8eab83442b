"""Checks and packing of vector columns, shared by the operators on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column, size: int | None = None) -> Column:
    """True for a vector without null or non-finite components, of `size` if one is given."""
    wide = vector.cast("array<double>")
    sound = F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    whole = vector.isNotNull() & sound
    return F.coalesce(whole if size is None else whole & (F.size(vector) == size), F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """Components times `scale`, rounded down; doubles, which hold these integers exactly."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))


def matrix(column: pa.Array, size: int, limit: int) -> np.ndarray:
    """The list column as integers, rows of fewer components filled with zeros.

    Integers beyond `limit` could not be multiplied exactly and raise an error.
    """
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(values) and float(np.abs(values).max()) > limit:
        raise ValueError(f"a component beyond {limit} after scaling has no exact 64-bit product")
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), size), np.int64)
    out[np.arange(size) < lengths[:, None]] = values.astype(np.int64)
    return out
