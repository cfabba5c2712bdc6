"""Vectorised spans and rolling hashes over the UTF-8 bytes of Arrow text columns.

Both word patterns in use exclude ASCII characters only, so a byte-wise look at UTF-8 finds the same words as the
pattern does: every byte of a non-ASCII character is 0x80 or above. Hashes have 64 bits.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that are looked at together; sets the memory numpy takes.
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: [^\x20\x09-\x0D]
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def release() -> None:
    """Hands freed memory back to the system; a reused worker would else keep what its largest task took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The function over Arrow batches, with :func:`release` at the end of each task."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each row starts; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return everything, offsets


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, starts) of runs of whole rows of about `limit` bytes; one longer row is its own run."""
    everything, offsets = text_buffer(column)
    low = 0
    while low < len(offsets) - 1:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, high, everything[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of true bytes; runs end where a row ends."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = np.zeros(n + 1, bool)
    joined[1:n] = inside[:-1] & inside[1:]
    joined[offsets] = False
    starts = np.flatnonzero(inside & ~joined[:-1])
    ends = np.flatnonzero(inside & ~joined[1:]) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per span of bytes."""
    powers, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every `size` consecutive values."""
    n = max(0, len(words) - size + 1)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = h * np.uint64(_BASE) + words[k : n + k]
    return mix(h)


def within_row(rows: np.ndarray, size: int) -> np.ndarray:
    """Which windows of `size` consecutive items lie in one row."""
    n = max(0, len(rows) - size + 1)
    return rows[:n] == rows[size - 1 : n + size - 1]


def per_row(rows: np.ndarray, n: int) -> np.ndarray:
    """Number of items of each of n rows."""
    return np.bincount(rows, minlength=n)
