"""Vector columns: which rows count, and matrices from Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from orrery.llm.common import col


def finite(vector: str):
    """True where a vector is there and has numbers only."""
    v = col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(v.isNotNull() & ~odd, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int, kind=np.float64) -> np.ndarray:
    """Rows of a list column; shorter ones are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), kind)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def lists(rows: np.ndarray) -> pa.Array:
    """A matrix as an Arrow list column."""
    offsets = np.arange(0, rows.size + 1, rows.shape[1] if rows.size else 1, dtype=np.int32)[: len(rows) + 1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; rows are not zero."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
