"""Word hashing of Arrow text batches in numpy: whole texts, bounded memory.

A batch's strings are one byte buffer.  Words (runs of non white space, A-Z lower-cased)
are found with array comparisons and hashed with a polynomial over random 64-bit byte
values; windows of words are combined from their hashes.  Nothing runs per word.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18          # bytes hashed at a time
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def randoms(n: int, seed: int) -> np.ndarray:
    """n reproducible 64-bit values."""
    step = 0x9E3779B97F4A7C15
    start = np.array([(seed * step) % 2 ** 64], dtype=_U)
    return mix64(start + np.arange(1, n + 1, dtype=_U) * _U(step))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = randoms(256, 7)
_BYTE[65:91] = _BYTE[97:123]                     # A-Z hash as a-z
_PRIME = 0x5851F42D4C957F2D
_INVERSE = pow(_PRIME, -1, 2 ** 64)
_SLOT = randoms(64, 11) | _U(1)                  # multipliers of window slots
_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK)
        _powers[:] = [np.concatenate(([_U(1)], np.full(size - 1, x, dtype=_U))).cumprod(dtype=_U)
                      for x in (_PRIME, _INVERSE)]
    return _powers[0], _powers[1]


def chunks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after last, bytes, row offsets) of runs of rows of about ``limit`` bytes;
    null texts are empty.  A longer text is a run of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, row) of every word."""
    inside = ~_SPACE[data]
    if not inside.any():
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    first[edges] = inside[edges]
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(offsets, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word; equal words (A-Z lower-cased) hash equally anywhere."""
    out = np.empty(len(start), dtype=_U)
    lo = 0
    while lo < len(start):                       # blocks of whole words
        hi = max(int(np.searchsorted(end, start[lo] + BLOCK, "right")), lo + 1)
        base, stop = int(start[lo]), int(end[hi - 1])
        power, inverse = _tables(stop - base + 1)
        total = np.zeros(stop - base + 1, dtype=_U)
        np.cumsum(_BYTE[data[base:stop]] * power[:stop - base], dtype=_U, out=total[1:])
        s, e = start[lo:hi] - base, end[lo:hi] - base
        out[lo:hi] = mix64((total[e] - total[s]) * inverse[s] + (e - s).astype(_U))
        lo = hi
    return out


def hash_word(word: str) -> int:
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(word_hashes(data, np.array([0]), np.array([len(data)]))[0])


def windows(words: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first word) of every run of k words inside one row."""
    n = len(words) - k + 1
    if n <= 0:
        z = np.zeros(0, dtype=np.int64)
        return z.astype(_U), z, z
    h = words[:n] * _SLOT[0]
    for j in range(1, k):
        h += words[j:n + j] * _SLOT[j]
    at = np.flatnonzero(row[:n] == row[k - 1:])
    return mix64(h[at]), row[at], at


def shingles(words: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of k words; a row with fewer words gives its whole sequence
    as one, a row without words nothing.  Rows come in order."""
    h, r, _ = windows(words, row, k)
    rows, first, count = np.unique(row, return_index=True, return_counts=True)
    short = np.flatnonzero(count < k)
    if len(short):
        extra = np.zeros(len(short), dtype=_U)
        for j in range(k - 1):
            has = count[short] > j
            extra[has] += words[first[short][has] + j] * _SLOT[j]
        extra = mix64(extra + count[short].astype(_U) * _SLOT[63])
        h, r = np.concatenate((h, extra)), np.concatenate((r, rows[short]))
        order = np.argsort(r, kind="stable")
        h, r = h[order], r[order]
    return h, r
