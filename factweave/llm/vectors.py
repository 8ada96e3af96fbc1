"""Small helpers for embedding columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector is not null, not empty, and all its components are finite."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(x) > 0) & finite, F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) of a list column whose vectors all have ``dim`` components."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def group_runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal rows."""
    cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    return np.concatenate([[0], cut]).astype(int), np.concatenate([cut, [len(keys)]]).astype(int)
