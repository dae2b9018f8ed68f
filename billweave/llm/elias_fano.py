"""Compact sorted numbers: Elias-Fano codes in numpy, queried for whole arrays at once.

A sorted value is split into low bits, kept as they are, and high bits, kept in unary in a bit row: value i
with high part h is the one at position h + i. Ones before the h-th zero are the values with a smaller high
part, so a search looks into one short range of low bits.
"""

from __future__ import annotations

import tempfile

import numpy as np

_HALVES = [np.uint64(h) for h in (32, 16, 8, 4, 2, 1)]
_ONE = np.uint64(1)


class BitRow:
    """Bits in 64-bit words, with the number of ones before each word."""

    def __init__(self, positions: np.ndarray, length: int):
        bits = np.zeros((length // 64 + 1) * 64, np.uint8)
        bits[positions] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.ones = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th one (or zero), counted from 0."""
        before = self.ones if ones else np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        at = np.searchsorted(before, k, "right") - 1
        at = np.minimum(at, len(self.words) - 1)
        rest = (k - before[at]).astype(np.int64)
        word = self.words[at] if ones else ~self.words[at]
        place = at * 64
        for half in _HALVES:
            lower = word & ((_ONE << half) - _ONE)
            count = np.bitwise_count(lower).astype(np.int64)
            up = rest >= count
            rest = np.where(up, rest - count, rest)
            word = np.where(up, word >> half, lower)
            place = place + np.where(up, int(half), 0)
        return place


class EliasFano:
    """Sorted numbers up to ``top``, compact and memory-mapped."""

    def __init__(self, values: np.ndarray, top: int):
        self.count = len(values)
        wanted = max(0, int(top // max(1, self.count)).bit_length() - 1)
        self.low_bits = next(b for b in (0, 8, 16, 32, 64) if b >= wanted)
        values = np.asarray(values, np.uint64)
        high = self._high(values)
        self.highs = int(top >> self.low_bits) + 1 if self.low_bits < 64 else 1
        self.row = BitRow(high + np.arange(self.count), self.count + self.highs)
        self.low = None
        if self.low_bits:
            self.low = mapped(values.astype(f"u{self.low_bits // 8}"))

    def _high(self, values: np.ndarray) -> np.ndarray:
        if self.low_bits == 64:
            return np.zeros(len(values), np.int64)
        return (values >> np.uint64(self.low_bits)).astype(np.int64)

    def access(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``."""
        high = (self.row.select(index, True) - index).astype(np.uint64)
        if self.low is None:
            return high
        low = self.low[index].astype(np.uint64)
        return low if self.low_bits == 64 else (high << np.uint64(self.low_bits)) | low

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, -1 where it is not there: a search for the successor among equal high bits."""
        values = np.asarray(values, np.uint64)
        if not self.count or not len(values):
            return np.full(len(values), -1, np.int64)
        high = self._high(values)
        known = high < self.highs
        high = np.where(known, high, 0)
        begin = np.where(high > 0, self.row.select(np.maximum(high - 1, 0), False) - (high - 1), 0)
        end = self.row.select(high, False) - high
        if self.low is None:
            return np.where(known & (begin < end), begin, -1)
        return np.where(known, find_within(self.low, begin, end, values.astype(self.low.dtype)), -1)


def find_within(sorted_parts: np.ndarray, begin: np.ndarray, end: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value in its own range of ``sorted_parts`` (each range is sorted), or -1."""
    low, high = begin.astype(np.int64).copy(), end.astype(np.int64).copy()
    last = len(sorted_parts) - 1
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) >> 1
        less = sorted_parts[middle] < values[going]
        low[going[less]] = middle[less] + 1
        high[going[~less]] = middle[~less]
        going = going[low[going] < high[going]]
    if last < 0:
        return np.full(len(values), -1, np.int64)
    return np.where((low < end) & (sorted_parts[np.minimum(low, last)] == values), low, -1)


def mapped(values: np.ndarray) -> np.ndarray:
    """The same array, backed by an unnamed temporary file instead of memory; it is gone with the array."""
    if not len(values):
        return values
    with tempfile.TemporaryFile() as file:
        values.tofile(file)
        file.flush()
        return np.memmap(file, values.dtype, "r", shape=values.shape)
