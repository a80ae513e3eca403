import random
import re
from collections import Counter

import numpy as np
import pytest
from framelake.llm import phrases
from framelake.llm.biindex import BiIndex
from pyspark.sql import functions as F


def brute(rows, least, covered=80, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q for p in candidates for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * f[p] >= covered * f[q := p[i : i + m]]}
        scored = []
        for p in candidates - gone:
            score, k = min((2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def result(df, **options):
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def test_equals_brute_force(messy, strange):
    rows = [(r["lang"], r["text"]) for r in messy.collect()]
    wanted = brute(rows, 8)
    assert wanted
    assert result(messy, least=8) == wanted
    assert result(strange.repartition(3), least=8, shard_words=500) == wanted  # many shards
    assert result(messy, least=8, top=5, covered=50) == brute(rows, 8, 50, 5)


def test_pieces_cases_and_separators(spark):
    texts = ["New\tYork, new york; NEW YORK!\x0bnew\x0cyork", "É é É é É é", "a b c d e" * 3, "one.two.one.two", "x  y \t x y", "\xa0 z \xa0 z", None, "", " , "]
    rows = [(["en", None, "und"][i % 3], t) for i, t in enumerate(texts * 4)]
    df = spark.createDataFrame(rows, "lang string, text string")
    for least in (1, 2, 5):
        assert result(df, least=least) == brute(rows, least)


def test_counts_of_all_phrases_whatever_the_filters_hold(spark, monkeypatch):
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.randint(0, 200)))) for _ in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string")
    wanted = brute(rows, 3)
    assert {len(r[2].split()) for r in wanted} == {2, 3}
    assert result(df, least=3) == wanted
    monkeypatch.setattr(phrases, "FILTER_BITS", 64)  # a filter that lets nearly all through
    assert result(df, least=3) == wanted


def test_empty_table(empty):
    assert phrases.collocations(empty).count() == 0


def test_longest_phrase_is_bounded(empty):
    with pytest.raises(ValueError):
        phrases.counted_phrases(empty, longest=5)


def test_score_beyond_64_bits(spark):
    a, l, r = 9 * 10**15, 9 * 10**15 + 7, 10**16
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    score = F.expr("cast(cast(2000000 as decimal(20,0)) * cast(a as decimal(18,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)")
    assert df.select(score).first()[0] == 2000000 * a // (l + r)


def test_intervals_of_both_sides(spark):
    rng = np.random.default_rng(1)
    text = np.concatenate([[0], rng.integers(1, 6, 300), [0], rng.integers(1, 6, 200), [0]])
    index = BiIndex.of(text, 6)
    again = BiIndex.from_bytes(index.to_bytes(), index.counts)
    plain = Counter(tuple(text[i : i + m].tolist()) for m in range(1, 5) for i in range(len(text) - m + 1))
    for one in (index, again):
        found = {}
        waves = [one.words()]
        for grow in (one.left, one.right, one.left):
            waves.append(grow(waves[-1]))
        for wave in waves:
            found |= {tuple(s): c for s, c in zip(wave.symbols.tolist(), wave.count.tolist())}
        assert found == {p: c for p, c in plain.items() if 0 not in p}
        right = one.left(one.right(one.right(one.words())))
        assert sorted(map(tuple, right.symbols.tolist())) == sorted(map(tuple, waves[3].symbols.tolist()))


def test_a_task_names_a_phrase_once_for_all_its_shards():
    import pyarrow as pa
    from framelake.llm import phrases

    class All:
        value = None

        @staticmethod
        def has(keys):
            return keys == keys

    All.value = All
    texts = ["a b c d", "b c d e", "a b c d", "x y"] * 20
    batch = pa.record_batch([pa.array(["en", "de"] * 40), pa.array(texts)], ["lang", "text"])
    indexes = list(phrases._indexes(8, All)(iter([batch])))
    assert len(indexes) > 10
    want = {}
    for lang, text in zip(["en", "de"] * 40, texts):
        words = text.split()
        for m in (2, 3, 4):
            for i in range(len(words) - m + 1):
                want[lang, " ".join(words[i : i + m])] = want.get((lang, " ".join(words[i : i + m])), 0) + 1
    made = [tuple(r.values()) for b in phrases._named([], 4)(iter(indexes)) for r in b.to_pylist()]
    assert {r[:2]: r[2] for r in made} == want and len(made) == len(want)
    parts = [b.slice(i, 3) for b in phrases._named([], 4)(iter(indexes)) for i in range(0, b.num_rows, 3)] * 4
    few = [tuple(r.values()) for b in phrases._summed(iter(parts), 4) for r in b.to_pylist()]  # with little room sums are partial
    assert sum(r[2] for r in few) == 4 * sum(want.values()) and {r[:2] for r in few} == set(want)


def copies(n):
    """``n`` times the same texts of the same shards, with many phrases that are frequent in all of them."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(60)) for _ in range(20)]
    return [("en" if i % 2 else "fr", t) for i, t in enumerate(texts * n)]


def test_numbers_and_texts_give_the_same_counts(spark, messy, monkeypatch):
    rows = [(r["lang"], r["text"]) for r in messy.collect()]
    assert result(messy, least=8, shard_words=500) == (wanted := brute(rows, 8))
    monkeypatch.setattr(phrases, "NUMBERED_WORDS", 1)  # too many frequent words to be numbered
    assert result(messy, least=8, shard_words=500) == wanted


def test_clashing_keys_of_words_are_not_numbered(spark, monkeypatch):
    words = spark.createDataFrame([("en", "a", 9), ("en", "b", 8), ("en", "c", 1)], "lang string, word string, n long")
    found = phrases._numbers(words, 8)
    keys = np.array([phrases._word_key("en", x) for x in (b"a", b"b", b"c")], np.uint64)
    assert sorted(found.of(keys).tolist()) == [0, 1, 2] and found.has(keys).tolist() == [True, True, False]
    assert phrases._Numbers(np.empty(0, np.uint64)).of(keys).tolist() == [0, 0, 0]
    clash = words.union(spark.createDataFrame([("en\0a", "b", 1), ("en", "a\0b", 9)], words.schema))  # one key for both
    assert phrases._numbers(clash, 8) is None


def test_a_frequent_phrase_is_named_once_for_all_shards(spark, monkeypatch):
    """Phrases by text came from every shard that has them: their number was that of shards times that of phrases."""
    named = spark.sparkContext.accumulator(0)
    plain = phrases._named

    def counted(*args):
        def rows(batches):
            for batch in plain(*args)(batches):
                named.add(batch.num_rows)
                yield batch

        return rows

    monkeypatch.setattr(phrases, "_named", counted)
    for n in (2, 8):
        df = spark.createDataFrame(copies(n), "lang string, text string").repartition(n)
        words, found = phrases.counted_phrases(df, least=n, shard_words=200)
        assert found.count() == found.select("lang", "phrase").distinct().count() > 1000
        assert named.value == 0


def test_rows_are_in_order_however_wide_the_numbers():
    from framelake.llm.biindex import _by_pair

    rng = np.random.default_rng(2)
    for most in (3, 1 << 20, (1 << 32) - 1):
        first, second = rng.integers(0, most, 500), rng.integers(0, 4, 500)
        order, pairs = _by_pair(first, second)
        assert order.tolist() == sorted(range(500), key=lambda i: (first[i], second[i], i)) and (np.diff(pairs.astype(object)) >= 0).all()
