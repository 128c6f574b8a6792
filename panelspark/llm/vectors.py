"""Embedding columns as NumPy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def usable(column: pa.Array) -> list[np.ndarray | None]:
    """Each row's vector in double precision; None if it is null, empty, zero or holds null or non-finite parts."""
    if not pa.types.is_list(column.type) and not pa.types.is_large_list(column.type):
        raise TypeError("an embedding is an array of numbers")
    if not len(column):
        return []
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    # flatten() leaves out what NULL rows may hide; a null part becomes NaN
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    out: list[np.ndarray | None] = []
    for end, n in zip(ends.tolist(), lengths.tolist()):
        v = flat[end - n : end]
        out.append(v if n and np.isfinite(v).all() and v.any() else None)
    return out


def unit(v: np.ndarray) -> np.ndarray:
    """``v`` at length one; scaled first, so that squares neither overflow nor vanish."""
    v = v / np.abs(v).max()
    return v / np.sqrt((v * v).sum())


def matrix(raw) -> np.ndarray:
    """Rows of binary doubles as one matrix."""
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
