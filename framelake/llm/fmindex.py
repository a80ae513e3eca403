"""A compressed FM-index over word numbers: BWT in a wavelet matrix, searched backwards for many patterns at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with constant-time rank: 64-bit words and a running count per word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int32)
        self.zeros = len(bits) - int(counts.sum())

    @classmethod
    def packed(cls, words: np.ndarray, length: int) -> Bits:
        """From the stored 64-bit words of a vector of this length."""
        out = cls(np.empty(0, np.uint8))
        out.words = words
        counts = np.bitwise_count(words).astype(np.int32)
        out.before = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int32)
        out.zeros = length - int(counts.sum())
        return out

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; ``text`` ends with a symbol smaller than all others."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    span = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:-span] = rank[span:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        span *= 2


class FMIndex:
    """Counts occurrences of symbol sequences; symbols are 0 (end), 1 (separator), and from 2."""

    def __init__(self, text: np.ndarray):
        self.n = len(text)
        order = suffix_array(text)
        bwt = text[order - 1]
        self.depth = max(1, int(text.max()).bit_length())
        self.levels = []
        now = bwt
        for level in range(self.depth - 1, -1, -1):
            bits = (now >> level) & 1
            self.levels.append(Bits(bits.astype(np.uint8)))
            now = np.concatenate([now[bits == 0], now[bits == 1]])
        symbols = np.arange(int(text.max()) + 1)
        smaller = np.searchsorted(np.sort(text), symbols)
        self.base = smaller - np.searchsorted(now, symbols) if (np.diff(now) >= 0).all() else smaller - self._down(symbols, np.zeros(len(symbols), np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits in zip(range(self.depth - 1, -1, -1), self.levels):
            ones = bits.rank(i)
            i = np.where((symbol >> level) & 1, bits.zeros + ones, i - ones)
        return i

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of symbol + pattern from those of the patterns."""
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.base[symbol]
        return base + both[: len(symbol)], base + both[len(symbol) :]


def repeated_windows(segments: list[np.ndarray], lone: np.ndarray, window: int) -> np.ndarray:
    """For every segment a mask of the windows (by start) that occur twice or more within the segments.

    The segments are streamed through their index. Backward search from a right end gives its matching statistic, the length of
    the longest repeated match that ends there; windows within it are repeated, windows that contain the failed match are
    not, so the next right end whose statistic can reach ``window`` lies before both. Segments that are not ``lone`` stand
    for several copies: all their windows are repeated.
    """
    lengths = np.array([len(s) for s in segments])
    masks = np.where(lone, 0, (1 << (lengths - window + 1)) - 1).astype(np.int64)
    flat = np.concatenate([np.append(s, 1) for s in segments] + [np.zeros(1, np.int64)])
    begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    index = FMIndex(flat)
    lane = np.flatnonzero(lone)
    end = lengths[lane].copy()
    at, lo, hi = end.copy(), np.zeros(len(lane), np.int64), np.full(len(lane), index.n)
    while len(lane):
        at = at - 1
        lo, hi = index.extend(flat[begin[lane] + at], lo, hi)
        twice = hi - lo >= 2
        full = twice & (end - at >= window)
        masks[lane[full]] |= np.int64(1) << at[full]
        done = twice & (at == 0)
        fail = ~twice
        end = np.where(fail, np.minimum(at, end - window - 1) + window, end)
        done |= fail & (end < window)
        at, lo, hi = np.where(fail, end, at), np.where(fail, 0, lo), np.where(fail, index.n, hi)
        stay = ~done
        lane, end, at, lo, hi = lane[stay], end[stay], at[stay], lo[stay], hi[stay]
    return masks
