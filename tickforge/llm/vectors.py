"""Whole vectors of an Arrow batch as integer matrices, for operators 11 and 12."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_length(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and float64 matrix of the vectors of each length that hold only finite
    entries; null vectors and vectors with a null, NaN or infinite entry are left out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    out = {}
    for size in np.unique(length[length >= 0]).tolist():
        rows = np.flatnonzero(length == size)
        flat = column.take(pa.array(rows)).flatten()
        # a null entry reads as NaN
        x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), size)
        fine = np.isfinite(x).all(axis=1)
        out[size] = rows[fine], x[fine]
    return out


def floor_scaled(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as int64.  A value beyond 2**62 has no such integer and fails
    the job: results of it would not be exact."""
    y = np.floor(scale * x)
    if y.size and np.abs(y).max() > 2.0**62:
        raise ValueError("a vector entry is too large for a 64-bit integer")
    return y.astype(np.int64)


def list_column(matrix: np.ndarray) -> pa.ListArray:
    """A matrix as an Arrow column of lists, without a copy per row."""
    n, d = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * d, d, dtype=np.int32) if d else np.zeros(n + 1, np.int32)),
                                    pa.array(np.ascontiguousarray(matrix).reshape(-1)))


def matrix_of(column: pa.Array, dim: int) -> np.ndarray:
    """The int64 matrix of a column of lists of ``dim`` integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dim)
