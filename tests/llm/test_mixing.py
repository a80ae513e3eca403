import hashlib
import re
from collections import Counter, defaultdict

from framelake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, weights=(5, 2, 1), share=1.5, repeats=2):
    """Targets by resharing until none is above its limit, and decisions by one global queue."""
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    total = defaultdict(int)
    for r, n in zip(rows, size):
        total[r[3]] += n
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(size)
    while open_:
        w = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / w > repeats * total[s]}
        if not full:
            target |= {s: left * weight[s] / w for s in open_}
            break
        for s in full:
            target[s] = float(repeats * total[s])
        left -= sum(target[s] for s in full)
        open_ -= full
    turn = [hashlib.md5(f"17:{'null' if r[0] is None else r[0]}".encode()).hexdigest() for r in rows]
    peers = Counter((r[3], t, n) for r, t, n in zip(rows, turn, size))
    entries = []
    for s in names:
        upto = 0
        own = sorted({(t, n) for r, t, n in zip(rows, turn, size) if r[3] == s})
        for t, n in own:
            upto += n * peers[(s, t, n)]
            for epoch in range(repeats):
                key = "1" if s is None else "0" + s
                entries.append(((epoch * total[s] + upto) / weight[s], key, epoch, t, n, n * peers[(s, t, n)]))
    taken, used = Counter(), 0
    for finish, key, epoch, t, n, words in sorted(entries):
        used += words
        if used <= share * sum(size):
            taken[(key, t, n)] += n
    return [(r[0], n, total[r[3]], target[r[3]], taken[("1" if r[3] is None else "0" + r[3], t, n)]) for r, n, t in zip(rows, size, turn)]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_mix_equals_brute_force(messy, strange):
    rows = [tuple(r) for r in messy.collect()]
    wanted = order(brute(rows))
    for df in (messy, strange):
        got = mixing.mix_sources(df).select("doc_id", "size", "source_size", "target", "taken").collect()
        got = order(tuple(r) for r in got)
        assert [(a, b, c, e) for a, b, c, d, e in got] == [(a, b, c, e) for a, b, c, d, e in wanted]
        assert all(abs(x[3] - y[3]) < 1e-6 for x, y in zip(got, wanted))


def test_taken_words_are_near_targets(spark):
    rows = [(i, "w " * (1 + i * 7919 % 90), "en", f"s{i % 6 if i % 3 else 0}", 0) for i in range(3000)]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    for r in out.groupBy("source").agg({"taken": "sum", "target": "max"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) < 200
    assert out.where("taken > 2 * size").count() == 0


def test_documents_come_as_often_as_taken(messy, strange):
    times = {(r["doc_id"], r["source"], r["size"]): r["times"] for r in mixing.mix_sources(messy).collect()}
    got = Counter((r["doc_id"], r["text"]) for r in mixing.mixed_documents(strange).collect())
    for (doc_id, source, text), n in Counter((r["doc_id"], r["source"], r["text"]) for r in messy.collect()).items():
        assert got[(doc_id, text)] == n * times[(doc_id, source, len(WORD.findall(text or "")))]
    assert mixing.mixed_documents(strange).columns == strange.columns


def test_empty_table(empty):
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


def test_reruns_and_partitions_do_not_matter(messy):
    a = mixing.mix_sources(messy.repartition(7)).select("doc_id", "taken").collect()
    b = mixing.mix_sources(messy.coalesce(1)).select("doc_id", "taken").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_the_cut_is_found_by_dividing(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(1)
    rows = [(rng.randint(0, 40) / 7, f"0s{rng.randint(0, 3)}", rng.randint(0, 1), f"{i:05d}", rng.randint(1, 9)) for i in range(700)]
    df = spark.createDataFrame([(*r, r[4]) for r in rows], "finish double, skey string, epoch int, turn string, size long, words long")
    total = sum(r[4] for r in rows)
    for budget in (0, 3, total // 3, total - 1, total, total + 5):
        want, used = set(), 0
        for r in sorted(rows):
            used += r[4]
            if used <= budget:
                want.add(r[3])
        for steps, at_once in ((1024, 1 << 16), (4, 1), (2, 50)):
            taken = mixing._cut(df, budget, steps, at_once)
            assert {r["turn"] for r in df.where(taken(F.col("finish"), F.col("epoch"))).collect()} == want
