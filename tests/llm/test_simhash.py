from collections import defaultdict

import numpy as np
import xxhash
from framelake.llm import simhash
from framelake.llm.graph import components

from .conftest import rows_of


def plain_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    votes = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprints_equal_bit_by_bit():
    for text in [None, "", " \n", "One", "one TWO three", "É a b c d é", *[r[1] for r in rows_of()[:20]]]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hashes_alike(spark):
    assert spark.sql("SELECT xxhash64('a b c d')").first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c d", 42)


def brute(rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    kinds = sorted(set(prints))
    root = groups([(a, b) for i, a in enumerate(kinds) for b in kinds[:i] if (a ^ b).bit_count() <= 4], kinds)
    least = defaultdict(list)
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[root[p]].append(r[0])
    return sorted(((r[0], f"{p:016x}", min(least[root[p]], default=None)) for r, p in zip(rows, prints)), key=str)


def test_groups_equal_brute_force(messy, strange):
    rows = [tuple(r) for r in messy.collect()]
    wanted = brute(rows)
    for df, tile in ((messy, 4096), (strange, 4)):
        got = sorted((tuple(r) for r in simhash.near_duplicates(df, tile=tile).collect()), key=str)
        assert got == wanted


def test_links_keep_every_connection(spark):
    """Dense balls of fingerprints: large buckets, tiles, and chains through them."""
    rng = np.random.default_rng(6)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(150):
            flips = rng.choice(64, rng.integers(1, 6), replace=False)
            fps.add(int(c) ^ sum(1 << int(f) for f in flips))
    fps = sorted(fps)
    nodes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    wanted = groups([(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 4], fps)
    for tile in (4096, 16):
        links = simhash.near_links(nodes, tile=tile).collect()
        unsigned = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in links]
        assert all((a ^ b).bit_count() <= 4 for a, b in unsigned)
        assert groups(unsigned, fps) == wanted


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001), (5001, 5002), (5002, 5000), (7, 7)]
    got = {r["u"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and all(got[1000 + i] == 1000 for i in range(1, 300)) and got[5001] == got[5002] == 5000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def similarity(a, b, n=5):
    s = [{" ".join(x.lower().split()[i : i + n]) for i in range(max(1, len(x.split()) - n + 1))} for x in (a, b)]
    return len(s[0] & s[1]) / len(s[0] | s[1])


def test_similar_texts_meet_and_others_do_not(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 6))
    rows, pairs = [], []
    for i in range(0, 400, 2):
        words = [word() for _ in range(int(rng.integers(120, 400)))]
        changed = list(words)
        for at in rng.choice(len(words), max(1, len(words) // 80), replace=False):
            changed[at] = word()
        rows += [(i, " ".join(words), "en", "s", 0), (i + 1, " ".join(changed), "en", "s", 0)]
        pairs.append((i, i + 1))
    named = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), tile=8).collect()}
    close = [(a, b) for a, b in pairs if similarity(rows[a][1], rows[b][1]) >= 0.82]
    assert len(close) > 100 and np.mean([named[a] == named[b] for a, b in close]) > 0.95
    assert all(named[k] in (k, k - k % 2) for k in named)  # no group beyond a pair


def test_one_document_of_each_group_stays(messy, strange, empty):
    out = simhash.one_of_each_group(strange)
    ids = [r["doc_id"] for r in out.collect()]
    assert out.columns == strange.columns and len(ids) == len(set(ids))
    assert 2 in ids and 3 not in ids and 60 in ids and 61 not in ids and 62 not in ids
    assert simhash.one_of_each_group(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0


def test_pairs_at_the_threshold_are_confirmed(spark):
    """Isolated pairs just above 0.8 are found, those just below are not."""
    rng = np.random.default_rng(21)
    rows, above, below = [], [], []
    for i in range(0, 600, 2):
        words = [f"w{x}" for x in rng.integers(0, 10**9, 404)]
        n = 9 if i % 4 else 8  # each changed word is in five of 400 shingles: similarity 0.798 or 0.818
        changed = [f"c{i}" if k in range(20, 20 + 40 * n, 40) else w for k, w in enumerate(words)]
        rows += [(i, " ".join(words), "en", "s", 0), (i + 1, " ".join(changed), "en", "s", 0)]
        (above if similarity(rows[i][1], rows[i + 1][1]) >= 0.8 else below).append(i)
    out = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    found = lambda ks: np.mean([out[k] == out[k + 1] for k in ks])
    assert len(below) > 100 and found(below) == 0
    assert len(above) > 100 and found(above) > 0.93


def test_rows_without_id_and_texts_under_one_id_stay_apart(spark):
    rng = np.random.default_rng(22)
    text = lambda: " ".join(f"w{x}" for x in rng.integers(0, 10**9, 60))
    texts = [text() for _ in range(40)]
    rows = [(None, t, "en", "s", 0) for t in texts[:20]] + [(7, t, "en", "s", 0) for t in texts[20:30]] + [(100 + k, t, "en", "s", 0) for k, t in enumerate(texts[30:])]
    rows += [(None, texts[0] + " more", "en", "s", 0), (101, texts[5], "en", "s", 0), (102, texts[6], "en", "s", 0), rows[3], rows[22]]
    out = simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    kept = [r["text"].removesuffix(" more") for r in out]
    assert sorted(kept) == sorted(texts)
    assert {r["doc_id"] for r in out if r["text"] in texts[5:7]} == {101, 102}
