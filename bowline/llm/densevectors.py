"""Dense vectors of an Arrow list column as numpy matrices."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def finite(vector: str) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    entry_ok = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    as_doubles = F.col(vector).cast("array<double>")
    return F.coalesce((F.size(as_doubles) > 0) & F.forall(as_doubles, entry_ok), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column without nulls; all rows must have one length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and lengths.min() != lengths.max():
        raise ValueError(f"vectors of {lengths.min()} and of {lengths.max()} entries in one table")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(lengths), -1)


def scaled(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * entry) as whole numbers; entries so large that doubles have gaps there are refused."""
    rows = np.floor(scale * rows.astype(np.float64))
    if rows.size and np.abs(rows).max() >= 2.0**53:
        raise ValueError(f"an entry times {scale} is not below 2 ** 53")
    return rows.astype(np.int64)
