import random
import re

import numpy as np
from framelake.llm import minhash

from .conftest import sentence


def shingles(text, w=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + w]) for i in range(max(1, len(words) - w + 1))} if words else set()


def brute(rows, percent=85):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)]
    return sorted([(*r, r[0] == r[2]) for r in out], key=str)


def result(df, **options):
    return sorted((tuple(r) for r in minhash.near_duplicates(df, **options).collect()), key=str)


def test_equals_brute_force(messy, strange, empty):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    wanted = brute(rows)
    assert len({r[2] for r in wanted}) < len(wanted)
    assert result(messy) == wanted
    assert result(strange.repartition(3)) == wanted
    assert result(empty) == []


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_chains_and_a_large_group_of_near_copies(spark):
    """Members of a group that its representatives do not reach, chains of edits, and groups at a similarity just below."""
    rng = random.Random(5)
    base = sentence(rng, 200).split()
    texts = [edited(rng, base, rng.randint(0, 6)) for _ in range(150)]  # pairs at 0.6 to 1
    chain = sentence(rng, 150).split()
    for i in range(40):  # each link changes two words of the last
        chain[i * 3] = f"link{i}"
        texts.append(" ".join(chain))
    texts += [sentence(rng, 100) for _ in range(30)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = brute(rows)
    assert result(df) == wanted
    assert result(df, tile=8) == wanted


def test_all_pairs_meet_where_representatives_close_too_little(spark, monkeypatch):
    rng = random.Random(6)
    texts = []
    for _ in range(6):
        base = sentence(rng, 120).split()
        texts += [edited(rng, base, 4) for _ in range(25)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    told = []
    plain = minhash.tiled
    monkeypatch.setattr(minhash, "tiled", lambda *a: told.append(1) or plain(*a))
    assert result(df, bands=48, rows=2, tile=10) == brute(rows)  # short bands: unlike texts share buckets
    assert told


def test_signatures_estimate_similarity_better_than_independent_ranks():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(200):
        both, one, two = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (40, 10, 10))
        a, b = np.concatenate([both, one]), np.concatenate([both, two])
        s = minhash.super_minhash(np.concatenate([a, b]), np.array([0, 50, 100]), 128)
        errors.append((s[0] == s[1]).mean() - 40 / 60)
    assert abs(np.mean(errors)) < 0.01
    assert np.var(errors) < 0.8 * (40 / 60) * (20 / 60) / 128  # independent permutations: J (1 - J) / size


def test_signatures_follow_the_definition():
    """One element at a time, as published."""
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (1, 3, 40, 700)]
    found = minhash.super_minhash(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), 24)
    for elements, row in zip(sets, found):
        wanted = [1 << 70] * 24
        for e in elements:
            places = list(range(24))
            for rank in range(24):
                with np.errstate(over="ignore"):
                    draw = int(minhash.mix(np.array([e + np.uint64(rank + 1) * minhash._STEP]))[0])
                k = rank + (((draw >> 32) * (24 - rank)) >> 32)
                places[rank], places[k] = places[k], places[rank]
                wanted[places[rank]] = min(wanted[places[rank]], (rank << 32) | (draw & 0xFFFFFFFF))
        assert row.tolist() == wanted


def test_sets_that_span_parts(monkeypatch):
    rng = np.random.default_rng(5)
    hashes, first = rng.integers(0, 1 << 63, 900).astype(np.uint64), np.array([0, 5, 5, 600, 900])
    whole = minhash.super_minhash(hashes, first, 64)
    monkeypatch.setattr(minhash, "SHINGLES_AT_ONCE", 37)
    assert (minhash.super_minhash(hashes, first, 64) == whole).all()


def test_union_find():
    u = minhash.Union([5, 2, 9, 7])
    assert u.join(5, 9) and u.join(9, 2) and not u.join(2, 5)
    assert [u.find(x) for x in (5, 2, 9, 7)] == [2, 2, 2, 7]
