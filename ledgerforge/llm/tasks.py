"""Small helpers that run inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 4 << 20  # text handled by one numpy step; keeps a task's arrays small
CACHE_WORDS = 200_000  # entries of a per-task word cache before it starts afresh


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, None for null."""
    return column.cast(pa.binary()).to_pylist()


def slices(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """Consecutive texts of about SLICE_BYTES; a longer text is a slice of its own."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or b"")
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, computed once for each word a task meets."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


# An odd multiplier (so that it has an inverse modulo 2**64), chosen freely.
STEP = 0x9E3779B97F4A7C15
STEP_INVERSE = pow(STEP, -1, 1 << 64)


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64."""
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class RollingHash:
    """Hashes of all runs of a given length over one array of word hashes."""

    def __init__(self, hashes: np.ndarray):
        self.count = len(hashes)
        self._sums = np.zeros(self.count + 1, np.uint64)
        np.cumsum(hashes * powers(STEP, self.count), out=self._sums[1:])
        self._shift = powers(STEP_INVERSE, self.count)

    def runs(self, length: int) -> np.ndarray:
        if self.count < length:
            return np.empty(0, np.uint64)
        starts = self.count - length + 1
        mixed = (self._sums[length:] - self._sums[:starts]) * self._shift[:starts]
        mixed ^= mixed >> np.uint64(32)
        return mixed * np.uint64(0xD6E8FEB86659FD93)


def bounds(lengths: Iterable[int]) -> np.ndarray:
    """Start of each item in a concatenation, and the total at the end."""
    lengths = np.fromiter(lengths, np.int64)
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def merged_runs(starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Union of [start, start + length) intervals as rows of (start, stop); starts ascend."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    stops = np.maximum.accumulate(starts + length)
    first = np.flatnonzero(np.r_[True, starts[1:] > stops[:-1]])
    return np.c_[starts[first], np.r_[stops[first[1:] - 1], stops[-1]]]
