"""Vectorised byte kernels over Arrow text buffers, used inside Spark tasks.

Texts of an Arrow batch lie end to end in one UTF-8 buffer. Words are found with a table over the
256 byte values, and get 64-bit hashes from one running sum, so no Python loop runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts of so many bytes are worked on at once; a longer single text is worked on alone.
SLICE_BYTES = 2_000_000

_ODD = 0x9E3779B97F4A7C15 | 1  # base of the polynomial hash
_INVERSE = pow(_ODD, -1, 1 << 64)
_VALUES = np.random.default_rng(7).integers(1, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of whole texts: (first row, end row, bytes, offsets)."""
    raw, at = text_buffer(column)
    n, first = len(at) - 1, 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        end = min(end, n)
        yield first, end, raw[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64 for positions below ``n``."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 1 << 16)
        _POWERS = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _ODD, np.uint64))])
        _INVERSES = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _INVERSE, np.uint64))])
    return _POWERS[:n], _INVERSES


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes."""
    total = np.zeros(len(raw) + 1, np.uint64)
    powers, inverses = _powers(len(raw) + 1)
    np.cumsum(_VALUES[raw] * powers[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def runs(raw: np.ndarray, at: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of allowed bytes that stay inside one text."""
    ok = np.zeros(len(raw) + 2, bool)
    ok[1:-1] = allowed[raw]
    edge = ok[1:] != ok[:-1]
    starts = np.flatnonzero(edge & ok[1:])
    ends = np.flatnonzero(edge & ok[:-1])
    # A run that goes over the border of two texts is cut there.
    borders = at[1:-1]
    borders = np.unique(borders[(borders > 0) & (borders < len(raw))])
    cut = borders[ok[borders] & ok[borders + 1]]
    if len(cut):
        starts = np.sort(np.concatenate([starts, cut]))
        ends = np.sort(np.concatenate([ends, cut]))
    return starts, ends


def rows_of(starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The row of each byte position; empty rows own nothing."""
    return np.searchsorted(at, starts, side="right") - 1


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)


def grams(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words inside a row, and the index of each first word.

    ``words`` are the word hashes of all rows end to end, ``counts`` the words per row.
    """
    ends = np.repeat(np.cumsum(counts), counts)
    first = np.flatnonzero(np.arange(len(words)) + k <= ends)
    value = np.full(len(first), 0x51ED270B5A8D1C3F + k, np.uint64)
    for i in range(k):
        value = value * np.uint64(0x9FB21C651E98DF25) + words[first + i]
        value = value ^ (value >> np.uint64(29))
    return mix(value), first


class HashTable:
    """Open addressing from 64-bit hashes to numbers 0, 1, 2, ... in order of insertion."""

    def __init__(self, bits: int = 12):
        self._clear(bits)

    def _clear(self, bits: int) -> None:
        self.bits, self.size = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys, -1 where unknown."""
        slot, mask = self._slots(keys), (1 << self.bits) - 1
        found = self.values[slot]
        open_ = np.flatnonzero((found >= 0) & (self.keys[slot] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            at = slot[open_]
            found[open_] = self.values[at]
            open_ = open_[(found[open_] >= 0) & (self.keys[at] != keys[open_])]
        return found

    def insert(self, keys: np.ndarray) -> np.ndarray:
        """Add distinct, absent keys; they get the next numbers in their order."""
        while (self.size + len(keys)) * 2 > 1 << self.bits:
            used = self.values >= 0
            old = self.keys[used][np.argsort(self.values[used])]
            self._clear(self.bits + 1)
            self._put(old)
        return self._put(keys)

    def _put(self, keys: np.ndarray) -> np.ndarray:
        numbers = np.arange(self.size, self.size + len(keys), dtype=np.int32)
        slot, mask = self._slots(keys), (1 << self.bits) - 1
        rest = np.arange(len(keys))
        while len(rest):
            at = slot[rest]
            free = self.values[at] < 0
            # Of several keys at one free slot, the last written wins; the others go on.
            self.values[at[free]] = numbers[rest[free]]
            self.keys[at[free]] = keys[rest[free]]
            lost = self.values[at] != numbers[rest]
            rest = rest[lost]
            slot[rest] = (slot[rest] + 1) & mask
        self.size += len(keys)
        return numbers


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for each (start, length), end to end."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def strings_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    data = raw.tobytes()
    return [data[a:b].decode("utf-8") for a, b in zip(starts.tolist(), ends.tolist())]


def binary_column(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Arrow binary values holding the bytes of ``counts`` numbers each."""
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * values.itemsize, out=offsets[1:])
    data = np.ascontiguousarray(values)
    large = pa.Array.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )
    return large.cast(pa.binary())
