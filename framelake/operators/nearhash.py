"""Near hashes: greedy selection in one sorted pass, star covers, lookups. Hashes are compared in tasks; no table of pairs is made on the way."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import discard, written
from . import ranges

#: Hashes of a block decided in its first pass; every later pass takes four times as many as all before.
FIRST_PASS = 1 << 16
#: Hashes of a block that look in one group for those that stay.
LOT = 1 << 16
#: Hashes that a task holds at once to compare others with, and others that pass one such set in one group.
TILE, ASKED = 1 << 18, 1 << 15
#: Hashes compared with a tile in one go, and the pairs that are looked at in one go.
_ROWS, _PAIRS = 64, 1 << 21


class KeptHashes:
    """A growing set of hashes that tells which others lie within ``threshold`` bits of one of them.

    Multi-index hashing: with a word for about every three bits of the threshold, two hashes within it differ by at most two bits in some word
    (pigeonhole), so every word is looked up with all its variants within that radius. The newest hashes are compared one by one
    until they are worth sorting.
    """

    def __init__(self, threshold: int, bits: int = 64):
        self.threshold = threshold
        words = max(1, min(8, (threshold + 3) // 3))
        edges = [round(bits * i / words) for i in range(words + 1)]
        self.words = []
        for a, b in zip(edges, edges[1:]):
            flips = [sum(1 << k for k in c) for r in range(threshold // words + 1) for c in combinations(range(b - a), r)]
            self.words.append((np.uint64(a), np.uint64((1 << (b - a)) - 1), np.array(flips, np.uint64)))
        self.sorted, self.tail = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.lists: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, hashes: np.ndarray) -> None:
        self.tail = np.concatenate([self.tail, hashes])
        if len(self.tail) > max(4096, len(self.sorted) // 4):
            self.sorted, self.tail = np.concatenate([self.sorted, self.tail]), np.empty(0, np.uint64)
            self.lists = []
            for shift, mask, _ in self.words:
                word = (self.sorted >> shift) & mask
                order = np.argsort(word)
                self.lists.append((word[order], order))

    def near(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), bool)
        for at in range(0, len(hashes), _ROWS):
            part = hashes[at : at + _ROWS]
            hit = (np.bitwise_count(part[:, None] ^ self.tail[None, :]) <= self.threshold).any(axis=1)
            for (shift, mask, flips), (values, order) in zip(self.words, self.lists):
                todo = np.flatnonzero(~hit)
                probes = (((part[todo] >> shift) & mask)[:, None] ^ flips[None, :]).ravel()
                lo, hi = np.searchsorted(values, probes, "left"), np.searchsorted(values, probes, "right")
                found = hi - lo
                row = np.repeat(np.repeat(todo, len(flips)), found)
                place = np.arange(len(row)) - np.repeat(np.cumsum(found) - found, found) + np.repeat(lo, found)
                close = np.bitwise_count(self.sorted[order[place]] ^ part[row]) <= self.threshold
                hit[row[close]] = True
            out[at : at + _ROWS] = hit
        return out


def _grouped(batches, keys: list[str]) -> Iterator[tuple[tuple, object]]:
    """Parts of sorted batches with equal keys, in order; a key may come in several parts."""
    for batch in batches:
        yield from batch.groupby(keys, sort=False, dropna=False)


def _greedy(block: str, threshold: int, bits: int):
    """For rows sorted by block and order: those without an earlier one that stays within ``threshold`` bits."""

    def rows(batches) -> Iterator:
        now, kept = object(), None
        for key, part in _grouped(batches, [block]):
            if key != now:
                now, kept = key, KeptHashes(threshold, bits)
            hashes = part["hash"].to_numpy().view(np.uint64)
            left = np.flatnonzero(~kept.near(hashes))
            stay = []
            while len(left):
                stay.append(left[0])
                left = left[np.bitwise_count(hashes[left] ^ hashes[left[0]]) > threshold]
            kept.add(hashes[stay])
            yield part.iloc[stay][[block, "hash"]]

    return rows


def _unseen(block: str, threshold: int, bits: int):
    """For rows sorted by block, lot and kind: those of kind 1 without one of kind 0 within ``threshold`` bits."""

    def rows(batches) -> Iterator:
        now, kept = object(), None
        for key, part in _grouped(batches, [block, "lot"]):
            if key != now:
                now, kept = key, KeptHashes(threshold, bits)
            kept.add(part.loc[part["kind"] == 0, "hash"].to_numpy().view(np.uint64))
            asked = part[part["kind"] == 1]
            if len(asked):
                yield asked[~kept.near(asked["hash"].to_numpy().view(np.uint64))][[block, "hash", "first"]]

    return rows


def kept_hashes(classes: DataFrame, threshold: int, block: str = "camera", bits: int = 64, first_pass: int = FIRST_PASS, lot: int = LOT) -> DataFrame:
    """(block, hash), written: going through a block's hashes in order of ``first``, one stays if no earlier one that stays lies within ``threshold`` bits.

    ``classes`` has different hashes of a block. A block goes through one sorted pass, which holds only what stays. A large block is cut
    into passes by order, each four times as large as all before, so their number is the logarithm of its size: first many tasks remove what lies near the
    hashes that stay from earlier passes, then the rest goes through its own pass.
    """
    place = classes.select(block, "hash", F.struct(*[F.col(f"first.{c}").alias(c) for c in classes.schema["first"].dataType.names]).alias("first"))
    placed = ranges.cut(place, [block], [F.col("first").asc()])
    sizes = ranges.before(placed, [block], n=F.lit(1))
    turn = F.when(F.col("n") < first_pass, 0).otherwise(F.floor(F.log(4.0, F.col("n") / first_pass)) + 1).cast("int")
    turns = written(sizes.select(F.col(block).alias("_b"), F.col("_part").alias("_p"), turn.alias("turn")))
    last = turns.agg(F.max("turn")).first()[0]
    cut = written(placed.join(turns.hint("merge"), F.col(block).eqNullSafe(F.col("_b")) & (F.col("_part") == F.col("_p"))).select(block, "hash", "first", "turn"))
    discard(placed, turns)
    kept, done = None, []
    for number in range((last if last is not None else -1) + 1):
        own = cut.where(F.col("turn") == number).select(block, "hash", "first")
        if kept is not None:
            lots = own.groupBy(F.col(block).alias("_b")).agg(F.ceil(F.count(F.lit(1)) / lot).cast("int").alias("lots")).hint("merge")
            same = F.col(block).eqNullSafe(F.col("_b"))
            asked = own.join(lots, same).select(block, F.pmod(F.xxhash64("hash"), "lots").cast("int").alias("lot"), F.lit(1).alias("kind"), "hash", "first")
            held = kept.join(lots, same).select(block, F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), F.lit(0).alias("kind"), "hash", F.lit(None).cast(own.schema["first"].dataType).alias("first"))
            met = held.union(asked).repartition(block, "lot").sortWithinPartitions(block, "lot", "kind")
            own = met.mapInPandas(_unseen(block, threshold, bits), own.schema)
        new = own.repartition(block).sortWithinPartitions(block, "first").mapInPandas(_greedy(block, threshold, bits), classes.select(block, "hash").schema)
        new = written(new)
        done.append(new)
        kept = new if kept is None else kept.union(new)
    out = written(kept) if len(done) > 1 else done[0] if done else written(classes.select(block, "hash").limit(0))
    discard(cut, *(done if len(done) > 1 else []))
    return out


class HashTile:
    """A set of hashes that gives all pairs within ``threshold`` bits of one of them.

    Multi-index hashing as in ``KeptHashes``, with tables of offsets: of words of w bits, one must differ by at most threshold / words bits, the last ones
    by one less. The number of words is the cheapest for the size of the set; where none is cheaper than comparing with all of it, all are compared.
    """

    def __init__(self, hashes: np.ndarray, threshold: int, bits: int = 64):
        self.hashes, self.threshold, self.words = hashes, threshold, []
        least = len(hashes) / 4  # a look at a bucket costs some four plain comparisons
        for words in range(max(1, bits // 20), min(bits, threshold + 1, 16) + 1):
            most, edges = threshold // words, [round(bits * i / words) for i in range(words + 1)]
            plan = [(a, b - a, most if i <= threshold - most * words else most - 1) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
            looks = [sum(comb(wide, r) for r in range(radius + 1)) for _, wide, radius in plan]
            cost = sum(n * (1 + len(hashes) / 2**wide) for n, (_, wide, _) in zip(looks, plan))
            if max(wide for _, wide, _ in plan) <= 22 and max(looks) <= 4096 and cost < least:
                least, self.words = cost, plan
        self.tables = []
        for at, wide, radius in self.words:
            word = self._word(hashes, at, wide)
            order = np.argsort(word, kind="stable")
            flips = np.array([sum(1 << k for k in c) for r in range(radius + 1) for c in combinations(range(wide), r)], np.int64)
            self.tables.append((np.searchsorted(word[order], np.arange((1 << wide) + 1)), order, hashes[order], flips))

    @staticmethod
    def _word(hashes: np.ndarray, at: int, wide: int) -> np.ndarray:
        return ((hashes >> np.uint64(at)) & np.uint64((1 << wide) - 1)).astype(np.int64)

    def near(self, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in ``asked``, place in the set, distance), every pair once, in parts of bounded size."""
        if not self.words:
            rows = max(1, min(_ROWS, _PAIRS // max(1, len(self.hashes))))
            for at in range(0, len(asked), rows):
                apart = np.bitwise_count(asked[at : at + rows, None] ^ self.hashes[None, :])
                i, j = np.nonzero(apart <= self.threshold)
                yield i + at, j, apart[i, j].astype(np.int32)
            return
        for number, ((at, wide, _), (offsets, order, hashes, flips)) in enumerate(zip(self.words, self.tables)):
            rows = max(1, _PAIRS // 8 // len(flips))
            for first in range(0, len(asked), rows):
                own = asked[first : first + rows]
                looks = (self._word(own, at, wide)[:, None] ^ flips[None, :]).ravel()
                start = offsets[looks]
                found = offsets[looks + 1] - start
                some = np.flatnonzero(found)
                start, found, who = start[some], found[some], some // len(flips)
                ends = np.cumsum(found)
                done = 0
                while done < len(found):
                    before = ends[done - 1] if done else 0
                    to = max(done + 1, int(np.searchsorted(ends, before + _PAIRS, "right")))
                    n = found[done:to]
                    place = np.arange(ends[to - 1] - before) + np.repeat(start[done:to] - (ends[done:to] - n - before), n)
                    i = np.repeat(who[done:to], n)
                    differ = own[i] ^ hashes[place]
                    apart = np.bitwise_count(differ)
                    good = apart <= self.threshold
                    for a, w, radius in self.words[:number]:  # pairs that an earlier word gave
                        good[good] = np.bitwise_count(self._word(differ[good], a, w)) > radius
                    yield i[good] + first, order[place[good]], apart[good].astype(np.int32)
                    done = to


def _compared(block: str, threshold: int, answer: str):
    """For rows sorted by block, tile, part and kind: those of kind 1 (b) are compared with the tile's of kind 0 (a)."""

    def rows(batches) -> Iterator:
        import pandas as pd

        now, held, tile = object(), [], None
        for key, part in _grouped(batches, [block, "tile", "part"]):
            if key != now:
                now, held, tile = key, [], None
            held.append(part.loc[part["kind"] == 0, "hash"].to_numpy().view(np.uint64))
            own = part.loc[part["kind"] == 1, "hash"].to_numpy().view(np.uint64)
            if not len(own):
                continue
            if tile is None:
                tile, held = HashTile(np.concatenate(held), threshold), []
            links = np.zeros(len(own), np.int64)
            for i, j, apart in tile.near(own):
                if answer == "links":
                    links += np.bincount(i, minlength=len(own))
                    continue
                a, b = own[i].view(np.int64), tile.hashes[j].view(np.int64)
                if answer == "pairs":
                    a, b, apart = a[a < b], b[a < b], apart[a < b]
                if len(a):
                    yield pd.DataFrame({block: [key[0]] * len(a), "hash": a, "other": b, "distance": apart})
            if answer == "links":
                yield pd.DataFrame({block: [key[0]] * len(own), "hash": own.view(np.int64), "links": links})

    return rows


def _met(asked: DataFrame, held: DataFrame, threshold: int, block: str, answer: str, tile: int) -> DataFrame:
    """(block, hash, other, distance), or (block, hash, links), of all hashes ``asked`` and ``held`` within ``threshold`` bits: parts of ``asked`` pass tiles of ``held``.
    "pairs" gives those with hash < other only."""
    count = lambda df, n, size: df.groupBy(F.col(block).alias(f"_{n}")).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(n))
    tiles, parts = count(held, "tiles", tile), count(asked, "parts", ASKED)
    sizes = tiles.join(parts.hint("merge"), F.col("_tiles").eqNullSafe(F.col("_parts"))).select(F.col("_tiles").alias("_b"), "tiles", "parts").hint("merge")
    same = F.col(block).eqNullSafe(F.col("_b"))
    dealt = lambda n: F.pmod(F.xxhash64("hash"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = held.join(sizes, same).select(block, dealt("tiles").alias("tile"), every("parts").alias("part"), F.lit(0).alias("kind"), "hash")
    sent = asked.join(sizes, same).select(block, every("tiles").alias("tile"), dealt("parts").alias("part"), F.lit(1).alias("kind"), "hash")
    # a number is given, or Spark would join the few bytes of many groups in one task
    number = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = own.union(sent).repartition(number, block, "tile", "part").sortWithinPartitions(block, "tile", "part", "kind")
    kind = held.schema[block].dataType.simpleString()
    schema = f"`{block}` {kind}, hash long, " + ("links long" if answer == "links" else "other long, distance int")
    return met.mapInPandas(_compared(block, threshold, answer), schema)


def kinds(frames: DataFrame, block: str) -> DataFrame:
    return frames.where("hash is not null").select(block, "hash").distinct()


def near_hashes(left: DataFrame, right: DataFrame, threshold: int = 10, block: str = "camera", tile: int = TILE) -> DataFrame:
    """(block, a, b, distance): every hash on the left with those on the right within ``threshold`` bits. The right side is held in tiles, through which the left
    is streamed; only what is near comes out. Both sides are made distinct first; hashes that are null are near to nothing."""
    return _met(kinds(left, block), kinds(right, block), threshold, block, "near", tile).toDF(block, "a", "b", "distance")


def star_cover(classes: DataFrame, threshold: int = 10, block: str = "camera", bits: int = 64, tile: int = TILE, **options) -> DataFrame:
    """(block, hash, n, rep, distance, links): one row for each different hash of a block, in place of pairs.

    ``rep`` is the nearest of the block's representatives, which are chosen greedily in order (``kept_hashes``), so that no two of them lie within
    ``threshold`` bits and every hash lies within it of one; ties go to the smaller hash. ``links`` counts the other hashes within ``threshold`` bits. ``near_pairs``
    makes the pairs from this.
    """
    own = written(classes)
    reps = kept_hashes(own, threshold, block, bits, **options)
    every = own.select(block, "hash")
    nearest = _met(every, reps, threshold, block, "near", tile).groupBy(block, "hash").agg(F.min(F.struct("distance", F.col("other").alias("rep"))).alias("x"))
    links = _met(every, every, threshold, block, "links", tile).groupBy(block, "hash").agg((F.sum("links") - 1).alias("links"))
    found = nearest.join(links.hint("merge"), nearest[block].eqNullSafe(links[block]) & (nearest["hash"] == links["hash"])).select(nearest[block].alias("_b"), nearest["hash"].alias("_h"), "x", "links")
    out = written(own.join(found.hint("merge"), F.col(block).eqNullSafe(F.col("_b")) & (F.col("hash") == F.col("_h"))).select(block, "hash", "n", "x.rep", "x.distance", "links"))
    discard(own, reps)
    return out


def near_pairs(classes: DataFrame, threshold: int = 10, block: str = "camera", tile: int = TILE) -> DataFrame:
    """(block, a, b, distance), a < b: the pairs that a star cover stands for, of its hashes or of any others. Only what is near comes out of the tasks; no
    table of pairs that lie further apart is made."""
    own = kinds(classes, block)
    return _met(own, own, threshold, block, "pairs", tile).toDF(block, "a", "b", "distance")
