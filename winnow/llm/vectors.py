"""Vector columns as numpy matrices, and native tests of their components."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """True where the vector and all its components are neither null nor NaN nor infinite."""
    inside = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(inside, F.lit(False))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column without nulls as doubles; shorter vectors are filled up with zeros."""
    flat = np.asarray(column.flatten(), np.float64)
    lengths = np.diff(np.asarray(column.offsets)) if len(column) else np.zeros(0, np.int64)
    if (lengths == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims))
    out[np.arange(dims)[None, :] < lengths[:, None]] = flat
    return out


def stacked(column: pd.Series, dims: int) -> np.ndarray:
    """The same for a column of numpy arrays."""
    out = np.zeros((len(column), dims))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out
