import hashlib
from collections import Counter

import numpy as np
from framelake.llm import fmindex, substring, words
from pyspark.sql import functions as F

from .conftest import sentence


def brute(rows, w):
    split = [(d, (t or "").encode().split()) for d, t in rows]
    seen = Counter(tuple(x[i : i + w]) for _, x in split for i in range(len(x) - w + 1))
    out = []
    for d, x in split:
        gone = {i + k for i in range(len(x) - w + 1) if seen[tuple(x[i : i + w])] > 1 for k in range(w)}
        kept = b" ".join(t for i, t in enumerate(x) if i not in gone)
        out.append((d, len(x), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df, **options):
    out = substring.without_repeats(df, **options).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_equals_brute_force(messy, strange):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    wanted = brute(rows, 35)
    assert any(r[2] for r in wanted)
    assert result(messy) == wanted
    assert result(strange, shard_words=50) == wanted
    assert result(messy, key_segments=0) == wanted  # every repeated key is dealt out by its windows


def test_shared_and_periodic_passages(spark):
    import random

    rng = random.Random(2)
    shared = [sentence(rng, n) for n in (34, 35, 36, 60, 90)]
    rows = []
    for i in range(90):
        parts = [sentence(rng, rng.randint(0, 60)), shared[i % 5], sentence(rng, rng.randint(0, 60))]
        if i % 6 == 0:
            parts.append(" ".join(["tick"] * (30 + i)))
        if i % 7 == 0:
            parts.append("a b c d e f g h i j " * (i % 11))
        rows.append((i, "\n".join(parts), "en", "s", 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    wanted = brute([(r[0], r[1]) for r in rows], 35)
    assert result(df) == wanted
    assert result(df.repartition(7), key_segments=3, shard_words=100) == wanted
    assert result(df, window=12, gram=4) == brute([(r[0], r[1]) for r in rows], 12)


def test_empty_table(empty):
    assert substring.without_repeats(empty).count() == 0


def test_index_counts_equal_plain_search():
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(2, 6, 300), 0)
    index = fmindex.FMIndex(text)
    assert index.levels and sorted(fmindex.suffix_array(text).tolist()) == list(range(301))
    for _ in range(200):
        pattern = rng.integers(2, 6, rng.integers(1, 6))
        lo, hi = np.array([0]), np.array([index.n])
        for c in pattern[::-1]:
            lo, hi = index.extend(np.array([c]), lo, hi)
        plain = sum((text[i : i + len(pattern)] == pattern).all() for i in range(len(text) - len(pattern)))
        assert max(0, int(hi[0] - lo[0])) == plain


def test_matching_masks_equal_plain_search():
    rng = np.random.default_rng(5)
    for _ in range(30):
        segments = list({tuple(rng.integers(2, 5, rng.integers(4, 12))) for _ in range(12)})
        lone = rng.random(len(segments)) < 0.8
        seen = Counter(s[i : i + 4] for s in segments for i in range(len(s) - 3))
        masks = fmindex.repeated_windows([np.array(s) for s in segments], lone, 4)
        for s, one, mask in zip(segments, lone, masks):
            wanted = sum(1 << i for i in range(len(s) - 3) if not one or seen[s[i : i + 4]] > 1)
            assert mask == wanted


def test_word_hashes_and_runs():
    texts = [b"a bb  a", b"", b" \t", "é x a".encode(), b"bb"]
    found = words.Words(texts, words.white_space())
    assert found.first.tolist() == [0, 3, 3, 3, 5, 6]
    assert found.hashes[0] == found.hashes[2] == found.hashes[4] and found.hashes[1] == found.hashes[5] and len(set(found.hashes.tolist())) == 3
    assert found.text(0, 3) == b"a bb a"
    rng = np.random.default_rng(0)
    values = rng.integers(0, 50, 400).astype(np.uint64)
    assert words.sliding_minimum(values, 28).tolist() == [values[i : i + 28].min() for i in range(len(values) - 27)]
    first = np.array([0, 100, 120, 400])
    begin, count, _, _ = words.minimizer_runs(values, first, 35, 8)
    windows = sorted(w for b, c in zip(begin, count) for w in range(b, b + c))
    assert windows == [*range(0, 66), *range(120, 366)] and count.max() <= 28
