"""Words of whole texts as numpy arrays, straight from Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: A-Z to a-z; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that make words once lower-cased: 0-9, a-z and everything beyond ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0..n-1 mod 2**64, kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 1 << 23:
            _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row begins (rows + 1 offsets); null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes each, or one longer row: whole texts, bounded memory."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


class Words:
    """The words of some texts: `doc` (row), `start`, `end` (bytes in `data`), `hash`; `first[r]:first[r+1]` are row r's."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data = LOWER[data]
        offsets = offsets - offsets[0]
        n = len(data)
        inside = WORD[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = inside[:-1]
        start = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty(n, bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.start, self.end = start, np.flatnonzero(inside & (~after | edge[1:])) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * powers(BASE_INVERSE, n + 1)[self.start] + (self.end - self.start).astype(np.uint64))
        self.first = np.searchsorted(start, offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def shingles(self, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(hash, place) of each k consecutive words of a row, by the place of the first. short: a row of
        fewer words, but not none, is one shingle of all its words."""
        h, n = self.hash, len(self.hash)
        if n >= k:
            value = h[: n - k + 1].copy()
            for j in range(1, k):
                value *= BASE
                value += h[j : n - k + 1 + j]
            place = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1 :])
            value = mix(value[place])
        else:
            value, place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if short:
            rows = np.flatnonzero((self.counts > 0) & (self.counts < k))
            if len(rows):
                extra = np.zeros(len(rows), np.uint64)
                for j in range(k - 1):
                    more = np.flatnonzero(self.counts[rows] > j)
                    extra[more] = extra[more] * BASE + h[self.first[rows[more]] + j]
                value = np.concatenate([value, mix(extra + np.uint64(k))])
                place = np.concatenate([place, self.first[rows]])
        return value, place
