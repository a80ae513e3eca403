"""A bidirectional FM-index over word numbers: the BWT of a text and of its reverse, each in a wavelet matrix.

Patterns of up to ``DEPTH`` symbols have an interval of rows on both sides; a pattern is extended to the left over the text's BWT
and to the right over the reverse's, and both intervals follow. Rows are ordered by their first ``DEPTH`` symbols only, which is all
that intervals of such patterns need.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from .fmindex import Bits

DEPTH = 4
#: Rows under the intervals that are extended in one go.
AT_ONCE = 1 << 18


def _by_pair(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of two numbers (below 2**32), and the pair of each in that order. Rows are sorted within one number with the pair where 64 bits
    are enough, which takes half the time."""
    width, room = int(max(first.max(), second.max())).bit_length(), np.uint64(len(first).bit_length())
    pair = (first.astype(np.uint64) << np.uint64(width)) | second.astype(np.uint64)
    if 2 * width + int(room) > 64:
        order = np.argsort(pair, kind="stable")
        return order, pair[order]
    pair = np.sort((pair << room) | np.arange(len(pair), dtype=np.uint64))
    return (pair & ((np.uint64(1) << room) - np.uint64(1))).astype(np.int64), pair >> room


def _order(text: np.ndarray) -> np.ndarray:
    """Rows of the circular text in the order of their first four symbols."""
    order, found = _by_pair(text, np.roll(text, -1))
    rank = np.empty(len(text), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(found[1:] != found[:-1])])
    return _by_pair(rank, np.roll(rank, -2))[0]


class Side:
    """The BWT of one reading direction."""

    def __init__(self, levels: list[Bits], counts: np.ndarray):
        self.levels = levels
        start = np.concatenate([[0], np.cumsum(counts)[:-1]])
        symbol, at = np.arange(len(counts)), np.zeros(len(counts), np.int64)
        for level, bits in zip(range(len(levels) - 1, -1, -1), levels):
            ones = bits.rank(at)
            at = np.where((symbol >> level) & 1, bits.zeros + ones, at - ones)
        self.base = start - at

    @classmethod
    def of(cls, text: np.ndarray, counts: np.ndarray) -> Side:
        now = text[_order(text) - 1].astype(np.uint32)
        levels = []
        for level in range(max(1, int(len(counts) - 1).bit_length()) - 1, -1, -1):
            bits = (now & np.uint32(1 << level)) != 0
            levels.append(Bits(bits.view(np.uint8)))
            now = np.concatenate([now.take(np.flatnonzero(~bits)), now.take(np.flatnonzero(bits))])
        return cls(levels, counts)

    def children(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """All symbols of the BWT within the intervals: (interval, symbol, lo of the extended pattern, its count, rows with smaller symbols)."""
        who, symbol, less = np.arange(len(lo)), np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for bits in self.levels:
            a = bits.rank(lo)
            ones = bits.rank(lo + size) - a
            zeros = size - ones
            left, right = np.flatnonzero(zeros), np.flatnonzero(ones)
            who = np.concatenate([who[left], who[right]])
            less = np.concatenate([less[left], (less + zeros)[right]])
            symbol = np.concatenate([symbol[left] << 1, (symbol[right] << 1) | 1])
            lo = np.concatenate([(lo - a)[left], (bits.zeros + a)[right]])
            size = np.concatenate([zeros[left], ones[right]])
        return who, symbol, self.base[symbol] + lo, size, less


class Patterns(NamedTuple):
    """Patterns of equal length: their symbols (a column each), rows on both sides, counts."""

    symbols: np.ndarray
    lo: np.ndarray
    back: np.ndarray
    count: np.ndarray

    def where(self, keep: np.ndarray) -> Patterns:
        return Patterns(*[x[keep] for x in self])

    def blocks(self):
        """In parts of about AT_ONCE rows."""
        ends = np.cumsum(self.count)
        at = 0
        while at < len(ends):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
            yield self.where(slice(at, stop))
            at = stop


class BiIndex:
    """Symbols are 0 (separator; the text begins and ends with it) and from 1; ``counts`` has one entry for each."""

    def __init__(self, forward: Side, backward: Side, counts: np.ndarray):
        self.forward, self.backward, self.counts = forward, backward, counts

    @classmethod
    def of(cls, text: np.ndarray, symbols: int) -> BiIndex:
        counts = np.bincount(text, minlength=symbols).astype(np.int64)
        return cls(Side.of(text, counts), Side.of(text[::-1].copy(), counts), counts)

    def to_bytes(self) -> bytes:
        return b"".join(bits.words.tobytes() for side in (self.forward, self.backward) for bits in side.levels)

    @classmethod
    def from_bytes(cls, data: bytes, counts: np.ndarray) -> BiIndex:
        depth, length = max(1, int(len(counts) - 1).bit_length()), int(counts.sum())
        words = np.frombuffer(data, np.uint64).reshape(2, depth, -1)
        return cls(*[Side([Bits.packed(w, length) for w in side], counts) for side in words], counts)

    def words(self) -> Patterns:
        """All patterns of one symbol but the separator."""
        lo = np.concatenate([[0], np.cumsum(self.counts)[:-1]])[1:]
        found = Patterns(np.arange(1, len(self.counts))[:, None], lo, lo, self.counts[1:])
        return found.where(np.flatnonzero(found.count))

    def left(self, of: Patterns) -> Patterns:
        """All patterns with one more symbol in front."""
        who, symbol, lo, count, less = self.forward.children(of.lo, of.count)
        made = Patterns(np.column_stack([symbol, of.symbols[who]]), lo, of.back[who] + less, count)
        return made.where(np.flatnonzero(symbol))

    def right(self, of: Patterns) -> Patterns:
        """All patterns with one more symbol behind."""
        who, symbol, back, count, less = self.backward.children(of.back, of.count)
        made = Patterns(np.column_stack([of.symbols[who], symbol]), of.lo[who] + less, back, count)
        return made.where(np.flatnonzero(symbol))
