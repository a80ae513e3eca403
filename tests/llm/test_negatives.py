import math
import random

import numpy as np
import pytest
from framelake.llm import negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, positives=5, n=10, low=30, high=90):
    kept = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v], label))
    last = lambda i: (1 << 63) - 1 if i is None else i
    out = []
    for a, (vec_id, v, label) in enumerate(kept):
        if vec_id is None or vec_id % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), last(i), i, k == label) for b, (i, w, k) in enumerate(kept) if b != a)
        for s, _, i, _ in [x for x in scored if x[3]][:positives]:
            found = [x for x in scored if not x[3] and low * -s <= 100 * -x[0] <= high * -s][:n]
            out += [(vec_id, i, r, x[2], -s, -x[0]) for r, x in enumerate(found, 1)]
    return sorted(out, key=str)


def result(df, **options):
    return sorted((tuple(r) for r in negatives.hard_negatives(df, **options).collect()), key=str)


def vectors(n, dimension, seed, spread=0.5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dimension))
    out = []
    for i in range(n):
        v = centres[rng.integers(12)] + spread * rng.normal(size=dimension)
        out.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), int(rng.integers(10))))
    return out


@pytest.mark.parametrize("dimension,spread", [(8, 0.2), (64, 0.5), (3, 2.0)])
def test_equals_brute_force(spark, dimension, spread):
    rows = vectors(900, dimension, dimension, spread)
    df = spark.createDataFrame(rows, SCHEMA)
    wanted = brute(rows)
    assert wanted
    assert result(df) == wanted
    assert result(df.repartition(5), shard_rows=(50, 90), codes=5) == wanted  # many shards


def test_nulls_ties_repeated_rows_and_strange_columns(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.1, 0.2]) for _ in range(4)], rng.choice([0, 1, 2, None])) for i in range(150)]
    rows += rows[:30] + [(None, [0.1] * 4, 1), (None, [0.2] * 4, 2), (300, None, 1), (400, [0.1, None, 0.1, 0.1], 1), (500, [float("nan")] * 4, 1)]
    rows += [(600, [float("inf"), 0.0, 0.0, 0.0], 1), (700, [], 1), (800, [0.3, 0.3], 2), (900, [-0.2] * 4, 1), (-100, [0.2, 0.1, 0.2, 0.2], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    wanted = brute(rows, every=10)
    assert any(r[1] is None or r[3] is None for r in wanted)
    strange = df.withColumns({c: F.lit(3) for c in ("rid", "shard", "kind", "score", "window", "vector", "rank")})
    assert result(df, every=10) == wanted
    assert result(strange, every=10, shard_rows=(20, 20), codes=3) == wanted


def test_empty_tables(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    assert result(spark.createDataFrame([(0, None, None)], SCHEMA)) == []
    assert result(spark.createDataFrame([(0, [0.5, 0.5], 1)], SCHEMA)) == []


def test_cells_come_in_descending_order_of_their_bounds():
    rng = np.random.default_rng(2)
    for _ in range(30):
        a, b = rng.integers(0, 6, rng.integers(1, 9)).astype(float), rng.integers(0, 6, rng.integers(1, 9)).astype(float)
        seen = list(negatives.multi_sequence(a, b))
        assert sorted((i, j) for _, i, j in seen) == [(i, j) for i in range(len(a)) for j in range(len(b))]
        assert [s for s, _, _ in seen] == sorted((s for s, _, _ in seen), reverse=True)
        assert all(s == a[i] + b[j] for s, i, j in seen)


def test_index_stops_early_on_separate_clusters():
    """Certified answers without a visit of all cells."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 3
    points = np.floor(256 * (centres[rng.integers(20, size=4000)] + 0.01 * rng.normal(size=(4000, 16))))
    books = [negatives.codebook(points[:, :8], 20), negatives.codebook(points[:, 8:], 20)]
    index = negatives.MultiIndex(np.arange(4000), np.arange(4000), np.zeros(4000), points, books)
    asked = 0

    def fits(at):
        nonlocal asked
        asked += len(at)
        return np.ones(len(at), bool)

    for q in points[:50]:
        scores = points @ q
        wanted = sorted(zip((-scores).tolist(), range(4000)))[:5]
        assert index.best(q, 5, fits) == [(-s, i) for s, i in wanted]
    assert asked < 50 * 4000 / 2
