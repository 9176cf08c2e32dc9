"""Binary codes of vectors: Arrow columns to numpy, and codes packed into 64-bit words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, dims) doubles of a list column, and which rows are usable.

    Null vectors, vectors of another length, and such with null or non-finite components are not.
    """
    n = len(column)
    out = np.zeros((n, dims))
    sizes = np.array([len(x) if (x := v.values) is not None else -1 for v in column], np.int64)
    good = sizes == dims
    if good.any():
        flat = column.filter(pa.array(good)).flatten()
        out[good] = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    good &= np.isfinite(out).all(1)  # a null component reads as NaN
    return out, good


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as little-endian 64-bit words, padded with zeros."""
    n, width = bits.shape
    words = -(-width // 64)
    padded = np.zeros((n, words * 64), bool)
    padded[:, :width] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8").reshape(n, words)
