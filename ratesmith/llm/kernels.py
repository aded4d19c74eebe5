"""Array kernels over the text buffers of Arrow batches.

A Spark task hands the operators Arrow batches; these helpers see a batch as one
UTF-8 byte buffer plus row offsets, and find words, lines and window hashes for all
rows of a slice at once.  They hold no state between batches, and a slice is at most
``SLICE_BYTES`` of text unless one row alone is longer, so a task's memory does not
grow with its partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply): spreads every input bit over the word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_values(seed: int = 0) -> np.ndarray:
    """One 64-bit value per byte value, from a counter."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i in [0, n)."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base & _MASK, inverse):
        p = np.full(max(n, 1), b, dtype=np.uint64)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        out.append(p)
    return out[0], out[1]


class Rolling:
    """Polynomial hashes of any spans of a sequence of 64-bit values, from one prefix sum."""

    def __init__(self, base: int = _BASE):
        self.base = base
        self.pow = self.inv = np.empty(0, dtype=np.uint64)

    def load(self, values: np.ndarray) -> "Rolling":
        n = len(values) + 1
        if len(self.pow) < n:
            self.pow, self.inv = powers(1 << (n - 1).bit_length(), self.base)
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(values * self.pow[: n - 1], out=self.sums[1:])
        return self

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inv[start]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset:] \
        if len(column) else np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole rows of at most ``limit`` bytes (one row may be longer)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        stop = min(stop, n)
        yield row, stop
        row = stop


def byte_class(allowed: bytes | None = None, *, excluded: bytes | None = None, high: bool = True) -> np.ndarray:
    """A boolean table over byte values; ``high`` says whether bytes of non-ASCII characters belong."""
    table = np.zeros(256, dtype=bool)
    if excluded is not None:
        table[:128] = True
        table[list(excluded)] = False
    else:
        table[list(allowed or b"")] = True
    table[128:] = high
    return table


# Words are runs of characters other than space and the ASCII controls 9-13.
SPACED_WORD = byte_class(excluded=bytes([32, *range(9, 14)]))
# Words of digits, ASCII letters and any non-ASCII characters (text is lower-cased first).
ALNUM_WORD = byte_class(allowed=b"0123456789abcdefghijklmnopqrstuvwxyz")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def edges(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of member bytes; runs never cross rows."""
    n = len(member)
    if n == 0:
        e = np.empty(0, dtype=np.int64)
        return e, e
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = member[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < n]
    before[inner] = False
    start = np.flatnonzero(member & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = member[1:]
    after[inner[inner > 0] - 1] = False
    return start, np.flatnonzero(member & ~after) + 1


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of member bytes; runs never cross rows."""
    start, end = edges(member, offsets)
    return start, end, np.searchsorted(offsets[1:], start, side="right")


def windows(row: np.ndarray, k: int) -> np.ndarray:
    """Indexes i with k consecutive items i..i+k-1 of one row (items are in row order)."""
    if len(row) < k:
        return np.empty(0, dtype=np.int64)
    return np.flatnonzero(row[: len(row) - k + 1] == row[k - 1:])


def counts(row: np.ndarray, n_rows: int) -> np.ndarray:
    return np.bincount(row, minlength=n_rows).astype(np.int64)


def row_sums(member: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many member bytes each row has."""
    total = np.zeros(len(member) + 1, dtype=np.int64)
    np.cumsum(member, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
