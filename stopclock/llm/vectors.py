"""Vectors of Arrow batches as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Integers made of components stay below this size, so that sums of squares fit 64 bits.
LARGEST = 1 << 27


def clean_matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of each length in a list column.

    A null or empty vector, and one with a null or non-finite component, is in none of them.
    """
    ends = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    if values.dtype.kind != "f":
        values = values.astype(np.float64)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    lengths = np.diff(ends)
    good = (bad[ends[1:]] == bad[ends[:-1]]) & (lengths > 0) & column.is_valid().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths[good]).tolist():
        rows = np.flatnonzero(good & (lengths == d))
        yield rows, values[ends[rows][:, None] + np.arange(d)]


def scaled(matrix: np.ndarray) -> np.ndarray:
    """floor(1024 * x) of every component, as whole numbers."""
    floors = np.floor(1024 * matrix.astype(np.float64))
    if floors.size and np.abs(floors).max() >= LARGEST:
        raise ValueError(f"a component is {LARGEST // 1024} or more, too large for whole-number distances")
    return floors.astype(np.int64)
