"""Elias-Fano coded monotone sequences: two bits and the low bits for each number, searched as they are."""

from __future__ import annotations

import numpy as np

_POPCOUNT = np.array([bin(b).count("1") for b in range(256)], dtype=np.int64)
_SELECT = np.zeros((256, 8), dtype=np.int64)
for _b in range(256):
    for _k, _at in enumerate([i for i in range(8) if _b >> i & 1]):
        _SELECT[_b, _k] = _at


class EliasFano:
    """A non-decreasing sequence of unsigned numbers below 2^64.

    High bits stand in unary in ``high`` (a one for each number, a zero after each value of the high part), low bits
    packed in ``low``. ``ones`` and ``zeros`` count them before each 64-bit word.
    """

    ARRAYS = ("high", "low", "ones")

    def __init__(self, n: int, low_bits: int, high: np.ndarray, low: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.high, self.low, self.ones = n, low_bits, high, low, ones

    @classmethod
    def of(cls, numbers: np.ndarray) -> EliasFano:
        numbers = numbers.astype(np.uint64)
        n = len(numbers)
        largest = int(numbers[-1]) if n else 0
        low_bits = max(0, (largest // max(1, n)).bit_length() - 1)
        tops = (numbers >> np.uint64(low_bits)).astype(np.int64) if low_bits < 64 else np.zeros(n, dtype=np.int64)
        places = tops + np.arange(n)
        words = int(places[-1] if n else 0) // 64 + 2
        high = np.zeros(words, dtype=np.uint64)
        np.bitwise_or.at(high, places >> 6, np.uint64(1) << (places & 63).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        low = np.zeros(n * low_bits // 64 + 2, dtype=np.uint64)
        if low_bits:
            bits = numbers & np.uint64((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.int64) * low_bits
            shift = (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, at >> 6, bits << shift)
            over = (at & 63) + low_bits > 64
            np.bitwise_or.at(low, (at[over] >> 6) + 1, bits[over] >> (np.uint64(64) - shift[over]))
        return cls(n, low_bits, high, low, ones)

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """The place of the k-th one (or zero), counted from 0."""
        before = self.ones if ones else np.arange(len(self.ones)) * 64 - self.ones
        word = np.searchsorted(before, k, side="right") - 1
        rest = k - before[word]
        bits = self.high[np.minimum(word, len(self.high) - 1)]
        bits = bits if ones else ~bits
        out = np.zeros(len(k), dtype=np.int64)
        done = np.zeros(len(k), dtype=bool)
        for byte in range(8):
            own = (bits >> np.uint64(8 * byte) & np.uint64(255)).astype(np.int64)
            here = ~done & (rest < _POPCOUNT[own])
            out[here] = 8 * byte + _SELECT[own[here], rest[here]]
            done |= here
            rest = np.where(done, rest, rest - _POPCOUNT[own])
        return word * 64 + out

    def _low(self, k: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(k), dtype=np.uint64)
        at = k * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        spill = shift > 0
        value[spill] |= self.low[word[spill] + 1] << (np.uint64(64) - shift[spill])
        return value & np.uint64((1 << self.low_bits) - 1)

    def get(self, k: np.ndarray) -> np.ndarray:
        """The numbers at places ``k``."""
        k = np.asarray(k, dtype=np.int64)
        top = (self._select(k, True) - k).astype(np.uint64)
        return (top << np.uint64(self.low_bits)) | self._low(k)

    def successor(self, wanted: np.ndarray) -> np.ndarray:
        """For each number the place of the first one that is not smaller; n if there is none.

        The high part leads to the few numbers that share it; these are halved by their low bits.
        """
        wanted = wanted.astype(np.uint64)
        if not self.n:
            return np.zeros(len(wanted), dtype=np.int64)
        tops = (wanted >> np.uint64(self.low_bits)).astype(np.int64)
        last = int(self.get(np.array([self.n - 1]))[0]) >> self.low_bits
        out = np.full(len(wanted), self.n, dtype=np.int64)
        some = np.nonzero(tops <= last)[0]
        tops = tops[some]
        lo = np.zeros(len(some), dtype=np.int64)
        later = tops > 0
        lo[later] = self._select(tops[later] - 1, False) - (tops[later] - 1)
        hi = self._select(tops, False) - tops
        hi = np.minimum(hi, self.n)
        low = wanted[some] & np.uint64((1 << self.low_bits) - 1)
        while (open_ := np.nonzero(lo < hi)[0]).size:
            middle = (lo[open_] + hi[open_]) >> 1
            smaller = self._low(middle) < low[open_]
            lo[open_[smaller]] = middle[smaller] + 1
            hi[open_[~smaller]] = middle[~smaller]
        out[some] = lo
        return out
