"""Exact words of texts as Arrow arrays, cut by byte classes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# The bytes that separate the words of the decontamination and search contracts.
APART = np.zeros(256, dtype=bool)
for first, last in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    APART[first:last + 1] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def split_words(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words of a run of texts and the number of words before each text (and after the last).

    `data` holds the texts' UTF-8 bytes end to end, `bounds` where each begins and the last ends.
    Words are maximal runs of bytes outside `APART` (so all of a longer character belongs to a
    word), with A-Z lowered; none crosses from one text into the next.
    """
    n = len(data)
    if n == 0:
        return pa.array([], pa.large_binary()), np.zeros(len(bounds), np.int64)
    inside = np.zeros(n + 1, dtype=bool)
    np.logical_not(APART[data], out=inside[:n])
    begins = inside[:n].copy()
    begins[1:] &= ~inside[:n - 1]
    stops = inside[:n] & ~inside[1:]
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    sizes = np.flatnonzero(stops) + 1 - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    letters = _LOWER[data[inside[:n]]]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words, np.searchsorted(starts, bounds)


def coded(words: pa.LargeBinaryArray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """Each word's number, and the distinct words by number."""
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary
