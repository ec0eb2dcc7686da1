"""Vectors of Arrow batches as integer matrices, shared by the operators on integer distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Squared distances up to here are whole numbers that 64-bit floats hold exactly.
EXACT = 1 << 53


def finite_vectors(lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, places, matrix)`` for each vector length: where its vectors stand, and their components.

    Null vectors and vectors with null or non-finite components are left out.
    """
    lengths = pc.fill_null(pc.list_value_length(lists), -1).to_numpy()
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    for length in np.unique(lengths[lengths >= 0]).tolist():
        places = np.flatnonzero(lengths == length)
        rows = values[starts[places, None] + np.arange(length)]
        good = np.isfinite(rows).all(axis=1)
        yield length, places[good], rows[good]


def scaled(rows: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """``floor(scale * x)`` as whole 64-bit floats, and which rows' squared distances stay below ``EXACT``.

    With every component of two vectors below a limit in size, no sum of their squared
    differences, nor a product on the way to it, passes ``EXACT``.
    """
    whole = np.floor(scale * rows)
    limit = np.sqrt(EXACT / 4 / max(1, rows.shape[1])) - 1
    return whole, (np.abs(whole) < limit).all(axis=1)
