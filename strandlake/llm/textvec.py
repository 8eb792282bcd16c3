"""Vectorised text primitives over Arrow string batches (NumPy only, no per-character Python)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes up to which words are hashed side by side; a run without white space can be as long as its text.
LONG_WORD = 64
#: A-Z to a-z; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that separate words: white space.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_FNV = np.uint64(0x100000001B3)
_BASIS = np.uint64(0xCBF29CE484222325)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_K = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (rows + 1) of a string column; nulls are empty rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first word of each row (rows + 1) of the maximal runs without separators."""
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first = inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1])))
    last = inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words: of all up to ``LONG_WORD`` bytes at once, byte position by byte position, of longer ones one by one."""
    h, left = np.full(len(starts), _BASIS), ends - starts
    live = np.flatnonzero(left <= LONG_WORD)
    at, left = starts[live], left[live]
    while len(live):
        h[live] = (h[live] ^ data[at].astype(np.uint64)) * _FNV
        left = left - 1
        keep = left > 0
        if not keep.all():
            live, at, left = live[keep], at[keep], left[keep]
        at = at + 1
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return mix(h + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; one hash of the whole run if there are fewer, none without words."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    h = np.full(n - k + 1, np.uint64(k))
    for j in range(k):
        h = mix(h * _K + words[j : n - k + 1 + j])
    return h


class Sums:
    """Counts by a 64-bit key, gathered over batches in bounded memory."""

    def __init__(self, most: int = 1_500_000):
        self.most, self.parts, self.size = most, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        u, c = np.unique(keys, return_counts=True) if counts is None else (keys, counts)
        self.parts.append((u, c))
        self.size += len(u)
        if self.size > self.most:
            self._merge()

    def _merge(self) -> None:
        if len(self.parts) > 1:
            k = np.concatenate([p[0] for p in self.parts])
            c = np.concatenate([p[1] for p in self.parts])
            order = np.argsort(k, kind="stable")
            k, c = k[order], c[order]
            at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            self.parts = [(k[at], np.add.reduceat(c, at))]
            self.size = len(at)

    def full(self) -> bool:
        return self.size > self.most * 3 // 4 and len(self.parts) == 1

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._merge()
        out, self.parts, self.size = self.parts[0], [], 0
        return out
