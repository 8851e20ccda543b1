"""Elias-Fano sequences over NumPy arrays, queried for many positions or values at once.

A sorted sequence of n values below u is kept as low bits (log2(u / n) each, packed) and high bits (a bit vector in which
the i-th one stands at high part + i). Counts of ones and zeros per 64-bit word serve selection.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
# Values that are cut into bits, or put together again, at once.
STEP = 1 << 16
_HALVES = (32, 16, 8, 4, 2, 1)


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The positions of the k-th (from 0) set bits; ``before`` counts those in earlier words."""
    word = np.searchsorted(before, k, side="right") - 1
    bits, left, at = words[word], k - before[word], np.zeros(len(k), np.int64)
    for half in _HALVES:
        under = np.bitwise_count((bits >> at.astype(U)) & U((1 << half) - 1)).astype(np.int64)
        beyond = left >= under
        left = left - under * beyond
        at += half * beyond
    return word * 64 + at


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones, self.zeros = n, low_bits, low, high, ones, zeros
        self.mask = U((1 << low_bits) - 1)

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, dtype=U)
        n = len(values)
        low_bits = max(0, min(63, (universe // max(n, 1)).bit_length() - 1))
        low = np.zeros(n * low_bits // 64 + 2, U)
        high = np.zeros(((universe >> low_bits) + n + 1) // 64 + 1, U)
        for a in range(0, n, STEP):
            some = values[a : a + STEP]
            i = np.arange(a, a + len(some))
            if low_bits:
                part = some & U((1 << low_bits) - 1)
                at = i * low_bits
                word, shift = at >> 6, (at & 63).astype(U)
                np.bitwise_or.at(low, word, part << shift)
                over = shift > 0
                np.bitwise_or.at(low, word[over] + 1, part[over] >> (U(64) - shift[over]))
            place = (some >> U(low_bits)).astype(np.int64) + i
            np.bitwise_or.at(high, place >> 6, U(1) << (place & 63).astype(U))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))[:-1]])
        return cls(n, low_bits, low, high, ones, np.arange(len(high)) * 64 - ones)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high, self.ones, self.zeros]

    def bare_arrays(self) -> list[np.ndarray]:
        """Without the counts for selection, for sequences that are only read through."""
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high]

    @classmethod
    def from_bare_arrays(cls, arrays: list[np.ndarray]) -> EliasFano:
        head, low, high = arrays
        nothing = np.zeros(0, np.int64)
        return cls(int(head[0]), int(head[1]), low, high, nothing, nothing)

    @classmethod
    def from_arrays(cls, arrays: list[np.ndarray]) -> EliasFano:
        head, *rest = arrays
        return cls(int(head[0]), int(head[1]), *rest)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), U)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(U)
        # Two shifts, as one by 64 would be undefined.
        return ((self.low[word] >> shift) | ((self.low[word + 1] << U(1)) << (U(63) - shift))) & self.mask

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        high = _select(self.high, self.ones, i) - i
        return (high.astype(U) << U(self.low_bits)) | self._low(i)

    def decoded(self) -> np.ndarray:
        """All values in order: for queries about as many as they are."""
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n]
        out = ones.view(U)
        # In place, a step at a time.
        for a in range(0, self.n, STEP):
            i = np.arange(a, min(a + STEP, self.n))
            out[i[0] : i[-1] + 1] = ((ones[i] - i).astype(U) << U(self.low_bits)) | self._low(i)
        return out

    def _below(self, high: np.ndarray) -> np.ndarray:
        """How many values have a high part up to ``high``; -1 gives 0."""
        some = np.maximum(high, 0)
        return np.where(high < 0, 0, _select(~self.high, self.zeros, some) - some)

    def find(self, values: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """The positions of ``values`` (below the universe), -1 where absent: the successor of each within the given
        ranges of positions, by binary search among values of one high part, and a comparison."""
        if not self.n or not len(values):
            return np.full(len(values), -1)
        values = np.asarray(values, dtype=U)
        high = (values >> U(self.low_bits)).astype(np.int64)
        left, right = self._below(high - 1), self._below(high)
        if begin is not None:
            left, right = np.maximum(left, begin), np.minimum(right, end)
        stop, wanted = right.copy(), values & self.mask
        going = np.nonzero(left < right)[0]
        while len(going):
            middle = (left[going] + right[going]) >> 1
            less = self._low(middle) < wanted[going]
            left[going] = np.where(less, middle + 1, left[going])
            right[going] = np.where(less, right[going], middle)
            going = going[left[going] < right[going]]
        there = left < stop
        out = np.full(len(values), -1)
        at = np.nonzero(there)[0]
        same = self._low(left[at]) == wanted[at]
        out[at[same]] = left[at[same]]
        return out


def packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays as one block of bytes, each on an 8-byte boundary."""
    kinds = [(a.dtype.str.encode().ljust(8), len(a)) for a in arrays]
    out = [np.int64(len(arrays)).tobytes()]
    for kind, n in kinds:
        out += [kind, np.int64(n).tobytes()]
    for a in arrays:
        data = np.ascontiguousarray(a).tobytes()
        out += [data, b"\0" * (-len(data) % 8)]
    return b"".join(out)


def unpacked(block: np.ndarray) -> list[np.ndarray]:
    """Views of the arrays in a block (an array of bytes, which may be memory-mapped)."""
    n = int(block[:8].view(np.int64)[0])
    at, out = 8 + 16 * n, []
    for i in range(n):
        head = 8 + 16 * i
        kind = np.dtype(bytes(block[head : head + 8]).decode().strip())
        size = int(block[head + 8 : head + 16].view(np.int64)[0]) * kind.itemsize
        out.append(block[at : at + size].view(kind))
        at += size + (-size % 8)
    return out
