"""Hard negatives through an inverted multi-index: cells of two half-space codebooks, visited by their score bounds."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .io import discard, stored, table

#: Codes of each half; a cell is a pair of them.
CODES = 16
#: The codebooks are fitted on at most this many rows, those of smallest hash. All rows are indexed.
SAMPLE_ROWS = 20_000
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
#: Rows of one shard of the index: at least, and at most (a shard is held by one task).
SHARD_ROWS = 4096, 1 << 20
#: Shards that a table is cut into, as far as their sizes allow.
SHARDS = 32
#: Rows scored in one go.
AT_ONCE = 512
#: Stands for a null vec_id, which comes last among equal scores.
_LAST = (1 << 63) - 1


def codebook(points: np.ndarray, codes: int = CODES, turns: int = 10) -> np.ndarray:
    """k-means centres of these points, at most ``codes``."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    kinds = np.unique(points, axis=0)
    centres = kinds[np.linspace(0, len(kinds) - 1, min(codes, len(kinds))).astype(int)]
    for _ in range(turns):
        near = nearest(points, centres)
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(first[i] + second[j], i, j) for all i, j in descending order of the sum, from a heap of the next candidates."""
    one, two = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[one[0]] + second[two[0]]), 0, 0)]
    done = np.full(len(one), -1)  # the last column taken of every row
    while heap:
        bound, a, b = heapq.heappop(heap)
        yield -bound, int(one[a]), int(two[b])
        done[a] = b
        # a neighbour is a candidate once those above it and before it are taken
        if a + 1 < len(one) and done[a + 1] == b - 1:
            heapq.heappush(heap, (-(first[one[a + 1]] + second[two[b]]), a + 1, b))
        if b + 1 < len(two) and (a == 0 or done[a - 1] >= b + 1):
            heapq.heappush(heap, (-(first[one[a]] + second[two[b + 1]]), a, b + 1))


class MultiIndex:
    """Rows of a shard in inverted lists by cell, with the radius of every code over the rows that have it."""

    def __init__(self, rid: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, books: list[np.ndarray]):
        self.half, self.books = books[0].shape[1], books
        halves = vectors[:, : self.half], vectors[:, self.half :]
        codes = [nearest(h, b) for h, b in zip(halves, books)]
        self.radii = []
        for h, c, b in zip(halves, codes, books):
            radius = np.full(len(b), -np.inf)  # codes without rows are never visited
            np.maximum.at(radius, c, np.sqrt(((h - b[c]) ** 2).sum(axis=1)))
            self.radii.append(radius)
        cell = codes[0] * len(books[1]) + codes[1]
        order = np.argsort(cell, kind="stable")
        self.rid, self.ids, self.labels, self.vectors = rid[order], ids[order], labels[order], vectors[order]
        self.starts = np.searchsorted(cell[order], np.arange(len(books[0]) * len(books[1]) + 1))

    def visits(self, anchor: np.ndarray, above: float = np.inf) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """(bound, places, scores) of the rows by cells in descending order of bound; no row after a part scores more than its bound.

        Cells whose rows all score more than ``above`` are passed over.
        """
        upper, lower = [], []
        for part, book, radius in zip((anchor[: self.half], anchor[self.half :]), self.books, self.radii):
            middle, reach = book @ part, np.sqrt(part @ part) * radius
            slack = 1e-9 * (np.abs(book) @ np.abs(part) + np.abs(reach)) + 1e-6
            upper.append(np.where(radius >= 0, middle + reach + slack, -np.inf))
            lower.append(middle - reach - slack)
        held, n = [], 0
        for bound, i, j in multi_sequence(*upper):
            if bound == -np.inf:
                break
            if n >= AT_ONCE:
                at = np.concatenate(held)
                yield bound, at, self.vectors[at] @ anchor
                held, n = [], 0
            a, b = self.starts[i * len(self.books[1]) + j : i * len(self.books[1]) + j + 2]
            if a < b and lower[0][i] + lower[1][j] <= above:
                held.append(np.arange(a, b))
                n += b - a
        at = np.concatenate([*held, np.empty(0, np.int64)])
        yield -np.inf, at, self.vectors[at] @ anchor

    def best(self, anchor: np.ndarray, n: int, fits) -> list[tuple[float, int]]:
        """The first n (score, id) of the rows that ``fits`` (places to booleans), by score descending and id."""
        found: list[tuple[float, int]] = []
        for bound, at, scores in self.visits(anchor):
            keep = fits(at)
            found = sorted([*found, *zip((-scores[keep]).tolist(), self.ids[at[keep]].tolist())])[:n]
            if len(found) == n and -found[-1][0] > bound:
                break
        return [(-s, i) for s, i in found]

    def within(self, anchor: np.ndarray, n: int, windows: list[tuple[float, float]], fits) -> list[list[tuple[float, int]]]:
        """For every window (low, high) of scores the first n (score, id) of the rows that fit, by score descending and id."""
        found: list[list[tuple[float, int]]] = [[] for _ in windows]
        open_ = set(range(len(windows)))
        for bound, at, scores in self.visits(anchor, max(h for _, h in windows)):
            keep = fits(at)
            scores, ids = scores[keep], self.ids[at[keep]]
            for k in list(open_):
                low, high = windows[k]
                hit = (scores >= low) & (scores <= high)
                if hit.any():
                    found[k] = sorted([*found[k], *zip((-scores[hit]).tolist(), ids[hit].tolist())])[:n]
                # certified: no row to come scores as much as the last one, or reaches the window
                if bound < low or (len(found[k]) == n and -found[k][-1][0] > bound):
                    open_.remove(k)
            if not open_:
                break
        return [[(-s, i) for s, i in x] for x in found]


def _rows(dimension: int):
    """Vectors of the first ``dimension`` components as 256 times their value, rounded down; shorter ones end in zeros."""

    def made(batches) -> Iterator:
        for batch in batches:
            vectors = []
            for x in batch["embedding"]:
                v = np.zeros(dimension)
                v[: len(x)] = np.floor(256 * np.asarray(x, float))
                vectors.append(v.tobytes())
            yield batch[["vec_id", "label"]].assign(vector=vectors)

    return made


def _matrix(column, dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), float).reshape(-1, dimension)


def _searched(books: list[np.ndarray], dimension: int, answer):
    """For rows sorted by shard and kind: the rows of kind 0 are a shard's index, those of kind 1 its anchors, answered one by one."""

    def rows(batches) -> Iterator:
        import pandas as pd

        shard, held, index = None, [], None
        for batch in batches:
            for key, part in batch.groupby("shard", sort=True):
                if key != shard:
                    shard, held, index = key, [], None
                own = part[part["kind"] == 0]
                if len(own):
                    held.append((own["rid"].to_numpy(), own["vec_id"].to_numpy(), own["label"].to_numpy(), _matrix(own["vector"], dimension)))
                asked = part[part["kind"] == 1]
                if len(asked) and held:
                    index, held = MultiIndex(*[np.concatenate(x) for x in zip(*held)], books), []
                if len(asked) and index is not None:
                    out = [r for q in asked.itertuples(index=False) for r in answer(index, q, np.frombuffer(q.vector, float))]
                    yield pd.DataFrame(out, columns=["rid", "window", "score", "vec_id"])

    return rows


def _positives(n: int):
    def answer(index: MultiIndex, q, vector):
        hits = index.best(vector, n, lambda at: (index.labels[at] == q.label) & (index.rid[at] != q.rid))
        return [(q.rid, 0, int(s), i) for s, i in hits]

    return answer


def _negatives(n: int, low: int, high: int):
    def answer(index: MultiIndex, q, vector):
        wanted = [int(x) for x in q.windows]
        hits = index.within(vector, n, [(low * x / 100, high * x / 100) for x in wanted], lambda at: index.labels[at] != q.label)
        # in whole numbers: the bounds of a window are hundredths
        return [(q.rid, x, int(s), i) for x, found in zip(wanted, hits) for s, i in found if low * x <= 100 * int(s) <= high * x]

    return answer


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, codes: int = CODES, shard_rows: tuple[int, int] = SHARD_ROWS, shards: int = SHARDS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for the anchors (vec_id divisible by ``every``) and each of
    their first positives, the first rows of another label that score between ``low`` and ``high`` percent of the positive.

    Scores are inner products of the components times 256, rounded down, exact up to 2^53. Rows without a label or vector, or with a null or
    non-finite component, take no part. Rows without vec_id are no anchors, and come last among equal scores. Vectors of
    different lengths are filled up with zeros. Repeated rows are rows of their own; an anchor leaves out itself only. Other columns are
    left out; an empty table gives no rows.

    The index is cut into shards by rows. Every shard holds inverted lists of the cells of two codebooks; every anchor goes through every shard, which
    visits its cells by the sum of the halves' bounds (centre and radius) until no other cell can change its answer. The shards' answers are merged.
    """
    fit = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    plain = vectors.where(fit).select(F.coalesce(F.col("vec_id").cast("long"), F.lit(_LAST)).alias("vec_id"), F.coalesce(moved, F.col("label").cast("long")).alias("label"), "embedding")
    total, dimension = plain.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    dimension = max(2, dimension)
    rows = stored(plain.mapInPandas(_rows(dimension), "vec_id long, label long, vector binary").withColumn("rid", F.monotonically_increasing_id()), "negatives-rows")
    sample = rows.select("vector").orderBy(F.xxhash64("vec_id"), "vector").limit(SAMPLE_ROWS).toPandas()
    points, half = _matrix(sample["vector"], dimension), dimension // 2
    books = [codebook(points[:, :half], codes), codebook(points[:, half:], codes)]
    n = max(1, -(-total // min(max(-(-total // shards), shard_rows[0]), shard_rows[1])))
    own = rows.select(F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int").alias("shard"), F.lit(0).alias("kind"), "rid", "vec_id", "label", "vector", F.lit(None).cast("array<long>").alias("windows"))
    asked = rows.where((F.col("vec_id") % every == 0) & (F.col("vec_id") != _LAST)).select("rid", "vec_id", "label", "vector")

    def search(anchors: DataFrame, answer) -> DataFrame:
        sent = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("shard"), F.lit(1).alias("kind"), "rid", "vec_id", "label", "vector", "windows")
        met = own.union(sent).repartition("shard").sortWithinPartitions("shard", "kind")
        return met.mapInPandas(_searched(books, dimension, answer), "rid long, window long, score long, vec_id long")

    def first(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("rid", "window").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    best = stored(first(search(asked.withColumn("windows", F.lit(None).cast("array<long>")), _positives(positives)), positives), "negatives-positives")
    windows = stored(best.groupBy("rid").agg(F.collect_set("score").alias("windows")), "negatives-windows")
    wanted = stored(asked.join(windows.hint("merge"), "rid"), "negatives-anchors")
    hard = stored(first(search(wanted, _negatives(negatives, low, high)), negatives), "negatives-found")
    pairs = best.select("rid", F.col("score").alias("window"), F.col("vec_id").alias("positive_id")).join(wanted.select("rid", F.col("vec_id").alias("anchor_id")).hint("merge"), "rid")
    out = stored(pairs.join(hard.hint("merge"), ["rid", "window"]), "negatives-out")
    for done in (rows, best, windows, wanted, hard):
        discard(done)
    named = [F.when(F.col(c) != _LAST, F.col(c)).alias(d) for c, d in (("positive_id", "positive_id"), ("vec_id", "negative_id"))]
    return out.select("anchor_id", named[0], F.col("rank").cast("int").alias("rank"), named[1], F.col("window").alias("positive_score"), F.col("score").alias("negative_score"))


def query(spark, sf_dir):
    return hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLE = r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND NOT list_contains([x IS NULL OR NOT isfinite(x) FOR x IN embedding], true)),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.a, p.b, p.score, s.b AS n, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS k
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT a AS anchor_id, b AS positive_id, k::INT AS rank, n AS negative_id, score AS positive_score, ns AS negative_score FROM n WHERE k <= 10
"""
