"""Word splitting and rolling word hashes over whole batches of texts, used inside tasks by several operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
#: Odd multiplier of the second, independent gram hash.
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
#: Bytes of text hashed at once; a longer single text is hashed alone.
CHUNK = 1 << 20


def byte_values() -> np.ndarray:
    """A fixed 64-bit value for every byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * _MULT)


def white_space() -> np.ndarray:
    """Separators of plain words: space and U+0009 to U+000D."""
    out = np.zeros(256, bool)
    out[[0x20, *range(0x09, 0x0E)]] = True
    return out


def not_alphanumeric() -> np.ndarray:
    """Separators of normalised words: every ASCII character that is neither letter nor digit."""
    return np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * _MIX_A
        values = (values ^ (values >> np.uint64(27))) * _MIX_B
    return values ^ (values >> np.uint64(31))


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts with about ``limit`` bytes."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


class Words:
    """Words of several texts: where they start and end in ``data``, their hashes, and the first word of each text."""

    def __init__(self, texts: list[bytes], separators: np.ndarray):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        solid = ~separators[self.data]
        edge = np.diff(solid.view(np.int8), prepend=np.int8(0))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        lengths = self.ends - self.starts
        begin = np.cumsum(lengths) - lengths
        at = np.flatnonzero(solid)
        place = np.arange(len(at)) - np.repeat(begin, lengths)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(lengths.max(initial=0)) + 1, _MULT, np.uint64))
            values = byte_values()[self.data[at]] * powers[place]
            self.hashes = mix(np.add.reduceat(values, begin)) if len(begin) else np.empty(0, np.uint64)
        offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])
        self.first = np.searchsorted(self.starts, offsets)

    def text(self, a: int, b: int) -> bytes:
        """Words a to b (exclusive) as they stand, joined by one space."""
        raw = self.data.tobytes() if not hasattr(self, "_raw") else self._raw
        self._raw = raw
        return b" ".join([raw[s:e] for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())])


def gram_hashes(hashes: np.ndarray, n: int, multiplier: np.uint64 = _MULT) -> np.ndarray:
    """Hash of each n consecutive words, order-sensitive; empty when there are fewer words."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = hashes[:m].copy()
        for j in range(1, n):
            out *= multiplier
            out += hashes[j : j + m]
    return mix(out)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[span:], values[:-span])
        span *= 2
    rest = width - span
    return np.minimum(values[rest:], values[:-rest]) if rest else values


def minimizer_runs(hashes: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of at most window - gram + 1 consecutive windows of one text that have the same smallest gram hash.

    ``first`` has the first word of each text, and the number of words at its end. Returns (first window, windows,
    that hash, whether windows of the run itself can be equal). Equal windows always have equal hashes, and every window lies in one run.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    if len(hashes) < window:
        return none
    width = window - gram + 1
    grams = gram_hashes(hashes, gram)
    least = sliding_minimum(grams, width)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(least)]
    at = np.flatnonzero(np.arange(len(least)) + window <= first[1:][text])  # windows within one text
    if not len(at):
        return none
    key = least[at]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)])
    index = np.arange(len(at))
    begin = np.maximum.accumulate(np.where(new, index, 0))
    starts = np.flatnonzero(new | ((index - begin) % width == 0))
    begin, count, key = at[starts], np.diff(np.append(starts, len(at))), key[starts]
    # equal windows of one run need its leftmost smallest gram to fall out of the later one
    leftmost = (grams[begin[:, None] + np.arange(width)] == key[:, None]).argmax(axis=1)
    return begin, count, key, leftmost < count - 1
