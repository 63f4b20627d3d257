"""Arrow columns of vectors as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def vector_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Usable rows (no null, no null or non-finite component) and their matrix of doubles.

    Shorter vectors are filled up with zeros, which changes no inner product.
    """
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)  # nulls become NaN
    sizes = np.diff(offsets)
    ok = ~np.asarray(column.is_null())
    width = int(sizes[ok].max()) if ok.any() else 0
    matrix = np.zeros((len(column), width))
    for size in np.unique(sizes[ok]):
        rows = np.flatnonzero(ok & (sizes == size))
        if size:
            matrix[rows, :size] = values[offsets[rows][:, None] + np.arange(size)]
    ok &= np.isfinite(matrix).all(axis=1)
    return np.flatnonzero(ok), matrix[ok]
