"""Vectors in columns and as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """Is there a vector, without a null or non-finite component?"""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def dimensions(vectors: DataFrame, name: str) -> int:
    """Components of the longest vector; shorter ones count as ending in zeros."""
    return vectors.agg(F.max(F.size(name))).first()[0] or 0


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """One row per vector, zeros behind its components."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), values.dtype)
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def lists(rows: np.ndarray) -> pa.ListArray:
    """A list for each row of a matrix."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1)))


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same seed."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))[0]
