"""Words of whole Arrow text columns as numpy arrays.

A batch's texts lie back to back in one UTF-8 buffer, so the words of all its
rows are found and hashed with a handful of array operations, without a Python
object per word. Only bytes matter here: both word definitions below are sets
of ASCII separators, and lower-casing changes A-Z alone, so no text needs to
be decoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; bounds the temporary arrays (about 40 bytes a
#: text byte). A longer single text is one slice of its own.
SLICE_BYTES = 1 << 21

#: byte -> byte with A-Z lowered
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: byte -> part of a word, for words [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: byte -> part of a word, for words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lowered text
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n or more of each."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets); a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    if at is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offsets = np.frombuffer(at, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset: column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]: offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of rows ``first`` to ``first + len(ptr) - 1`` of a batch.

    ``data`` holds the rows' bytes with A-Z lowered; word w is
    ``data[start[w]:end[w]]`` and row r has words ``ptr[r]`` to ``ptr[r+1]``.
    """

    first: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    ptr: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.ptr) - 1

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes (polynomial, then mixed)."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        up, down = _power_tables(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        raw = (total[self.end] - total[self.start]) * down[self.start]
        return mix(raw + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def joined(self, first: int, last: int) -> bytes:
        """Words first to last - 1 with one space between."""
        return b" ".join(self.data[s:e].tobytes()
                         for s, e in zip(self.start[first:last], self.end[first:last], strict=True))


def slices(column: pa.Array | pa.ChunkedArray, is_word: np.ndarray,
           slice_bytes: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of all rows, a bounded number of text bytes at a time."""
    data, offsets = utf8(column)
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + slice_bytes, side="right")) - 1
        last = min(max(last, first + 1), rows)
        at = offsets[first: last + 1] - offsets[first]
        part = LOWER[data[offsets[first]: offsets[last]]]
        yield _words(first, part, at, is_word)
        first = last


def _words(first: int, data: np.ndarray, at: np.ndarray, is_word: np.ndarray) -> Words:
    n = len(data)
    inside = is_word[data]
    before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    if n:
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = at[(at > 0) & (at < n)]  # a word never crosses from one row into the next
        before[edges] = False
        after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(first, data, start, end, np.searchsorted(start, at), at)


#: odd multipliers, one for each place in a window
_PLACE = [((0x9FB21C651E98DF25 * (2 * k + 1)) ^ (k << 40)) & (2**64 - 1) | 1 for k in range(64)]


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive words, by its first word.

    Windows that cross a row's end are included; callers use those within a row.
    """
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out += h[k: k + n] * np.uint64(_PLACE[k % 64])
    return mix(out)
