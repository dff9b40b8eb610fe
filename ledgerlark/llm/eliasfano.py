"""Elias-Fano coding of non-decreasing integers, with vectorised access and search.

Values are split into low bits, packed, and high parts, coded in unary: a one for each value, a zero
for each step of the high part.  Counts of ones and zeros before every 64-bit word stand beside the
bits, so that select is a search there and a look into one word.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_POP = np.array([bin(i).count("1") for i in range(256)], np.int64)
_SELECT = np.full((256, 8), 8, np.int64)
for _b in range(256):
    for _r, _i in enumerate(i for i in range(8) if _b >> i & 1):
        _SELECT[_b, _r] = _i


def _pack(bits: np.ndarray) -> np.ndarray:
    raw = np.packbits(bits, bitorder="little")
    return np.concatenate([raw, np.zeros(-len(raw) % 8 + 8, np.uint8)]).view(U)


def ef_build(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """Arrays of the coded values (uint64, non-decreasing), their names starting with `name`."""
    values = values.astype(U)
    n = len(values)
    top = int(values[-1]) if n else 0
    low = max(0, (top // max(n, 1)).bit_length() - 1)
    bits = np.zeros(n * low, np.uint8)
    for j in range(low):
        bits[j::low] = ((values >> U(j)) & U(1)).astype(np.uint8)
    high = (values >> U(low)).astype(np.int64)
    unary = np.zeros(n + (int(high[-1]) if n else 0) + 1, np.uint8)
    unary[high + np.arange(n)] = 1
    words = _pack(unary)
    ones = np.concatenate([[0], np.cumsum(_POP[words.view(np.uint8)].reshape(-1, 8).sum(axis=1))])[:-1]
    zeros = np.arange(len(words)) * 64 - ones
    return {f"{name}.size": np.array([n, low, len(unary)], np.int64), f"{name}.low": _pack(bits), f"{name}.high": words, f"{name}.ones": ones.astype(np.int64), f"{name}.zeros": zeros.astype(np.int64)}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.n, self.low_bits, self.length = (int(x) for x in arrays[f"{name}.size"])
        self.low_words, self.high = arrays[f"{name}.low"], arrays[f"{name}.high"]
        self.ones, self.zeros = arrays[f"{name}.ones"], arrays[f"{name}.zeros"]

    def _select(self, k: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Position of the k-th (from 0) one, or zero if flip."""
        w = np.searchsorted(before, k, "right") - 1
        r = k - before[w]
        word = self.high[w]
        if flip:
            word = ~word
        at = w * 64
        found = np.zeros(len(k), np.int64)
        open_ = np.ones(len(k), bool)
        for _ in range(8):
            byte = (word & U(255)).astype(np.int64)
            here = _POP[byte]
            hit = open_ & (r < here)
            found[hit] = at[hit] + _SELECT[byte[hit], r[hit]]
            open_ &= ~hit
            if not open_.any():
                break
            r, at, word = r - here, at + 8, word >> U(8)
        return found

    def low(self, i: np.ndarray) -> np.ndarray:
        l = self.low_bits
        if not l:
            return np.zeros(len(i), U)
        bit = i.astype(np.int64) * l
        w, off = bit >> 6, (bit & 63).astype(U)
        first = self.low_words[w] >> off
        rest = (self.low_words[w + 1] << U(1)) << (U(63) - off)
        return (first | rest) & U((1 << l) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        return ((self._select(i, self.ones, False) - i).astype(U) << U(self.low_bits)) | self.low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each x, -1 where it is not coded: successor search among the values of its high part."""
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        high = (x >> U(self.low_bits)).astype(np.int64)
        may = np.flatnonzero(high < self.length - self.n)
        h = high[may]
        end = self._select(h, self.zeros, True) - h
        begin = np.zeros(len(h), np.int64)
        some = h > 0
        begin[some] = self._select(h[some] - 1, self.zeros, True) + 1 - h[some]
        live = end > begin
        may, lo, hi = may[live], begin[live], end[live]
        want = x[may] & U((1 << self.low_bits) - 1)
        last = hi
        while (lo < hi).any():
            mid = (lo + hi) >> 1
            less = (self.low(np.minimum(mid, self.n - 1)) < want) & (lo < hi)
            lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, np.maximum(mid, lo))
        good = lo < last
        may, lo, want = may[good], lo[good], want[good]
        same = self.low(lo) == want
        out[may[same]] = lo[same]
        return out
