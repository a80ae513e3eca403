import random

import numpy as np
from framelake.llm import decontaminate as dc

ITEMS = "item_id long, text string"


def smith_waterman(a, b, match=2, miss=-1, gap=-1):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (match if a[i - 1] == b[j - 1] else miss), h[i - 1, j] + gap, h[i, j - 1] + gap)
    return h.max()


def test_alignment_equals_cell_by_cell():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 15)).astype(np.uint64), rng.integers(0, 4, rng.integers(1, 30)).astype(np.uint64)
        score, lo, hi, equal = dc.align(a, b)
        assert score == smith_waterman(a, b) and 0 <= lo <= hi <= len(b) and equal <= min(len(a), hi - lo)


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    items = [[word() for _ in range(rng.randint(15, 50))] for _ in range(8)]
    filler = lambda n: [word() for _ in range(n)]
    docs, leaks = [], set()
    for i in range(120):
        words = filler(rng.randint(0, 200))
        if i % 5 == 0:
            item = rng.randrange(8)
            copy = list(items[item])
            if i % 10 == 0:  # an edited copy: a word changed, one lost, one new
                copy[6] = "changed"
                del copy[11]
                copy.insert(3, "new")
            at = rng.randint(0, len(words))
            words[at:at] = copy
            leaks.add((i, item))
        docs.append((i, (" " if i % 2 else ", ").join(words).upper() if i % 3 == 0 else " ".join(words), "en", "s", 0))
    return docs, [(k, " ".join(w)) for k, w in enumerate(items)], leaks


def test_leaks_are_found_and_clean_documents_left(spark):
    docs, items, leaks = corpus()
    items = spark.createDataFrame([*items, (50, "too short"), (51, None), (52, ""), (0, items[0][1])], ITEMS)
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = dc.contaminated(frame, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == leaks and len(got) == len(leaks)
    many = dc.contaminated(frame, items, at_once=40).collect()  # the benchmark in parts
    assert {(r["doc_id"], r["item_id"]) for r in many} == leaks
    kept = dc.without_benchmark(frame, items)
    assert {r["doc_id"] for r in kept.collect()} == {d[0] for d in docs} - {a for a, _ in leaks}


def test_a_passage_in_every_document_is_still_a_leak(spark):
    docs, items, _ = corpus()
    rows = [(i, f"{i} {items[2][1]} {i * 7}", "en", "s", 0) for i in range(200)]
    got = dc.contaminated(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(items, ITEMS))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(i, 2) for i in range(200)}


def test_messy_rows(spark, messy, strange, empty):
    text = messy.where("doc_id = 8").first()["text"]
    items = spark.createDataFrame([(1, text)], ITEMS)
    assert {r["doc_id"] for r in dc.contaminated(strange, items).collect()} == {8}
    kept = dc.without_benchmark(strange, items)
    assert kept.columns == strange.columns and kept.count() == strange.count() - 1
    none = spark.createDataFrame([], ITEMS)
    assert dc.contaminated(messy, none).count() == 0 and dc.contaminated(empty, items).count() == 0
    assert dc.without_benchmark(messy, none).count() == messy.count()


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def invented(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n)]


def test_a_large_group_of_edited_copies_is_found(spark):
    """Seeds of the edited copy are in 300 documents, the item's others in three."""
    rng = random.Random(11)
    item = invented(rng, 59)
    edited = [f"other{k}" if k % 5 == 2 else w for k, w in enumerate(item)]
    rows = [(i, " ".join([*invented(rng, 20), *(item if i < 3 else edited), *invented(rng, 20)]), "en", "s", 0) for i in range(303)]
    rows += [(1000 + i, " ".join(invented(rng, 80)), "en", "s", 0) for i in range(20)]
    docs, items = spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame([(1, " ".join(item))], ITEMS)
    assert {r["doc_id"] for r in dc.contaminated(docs, items).collect()} == set(range(303))


def test_every_run_and_every_share_is_found(spark):
    rng = random.Random(12)
    item = invented(rng, 59)
    around = lambda words: " ".join([*invented(rng, 100), *words, *invented(rng, 100)])
    tail = [f"new{k}" if k % 3 == 0 else w for k, w in enumerate(item[15:35])]
    fourth = [f"new{k}" if k % 4 == 3 else w for k, w in enumerate(item)]
    between = [x for k, w in enumerate(item) for x in ([w, f"new{k}"] if k % 2 else [w])]
    few = [f"new{k}" if k % 3 == 2 else w for k, w in enumerate(item)]  # share 0.5, runs of two words
    texts = {1: around(item[:15] + tail), 2: around(fourth), 3: around(between), 4: around(item[20:33]), 5: around(item[20:32]), 6: around(few), 7: around(fourth * 40)}
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts.items()], DOCUMENTS)
    got = {r["doc_id"]: r for r in dc.contaminated(docs, spark.createDataFrame([(1, " ".join(item))], ITEMS)).collect()}
    assert set(got) == {1, 2, 3, 4, 7}
    assert (got[1]["first_word"], got[1]["end_word"], got[1]["equal_words"]) == (100, 115, 15)


def test_seeds_leave_out_no_alignment():
    """Random edits of every strength: what brute force reports has the seeds and words that are asked for."""
    rng = random.Random(13)
    reported = 0
    for _ in range(300):
        item = np.array(rng.sample(range(1000), rng.randint(6, 40)), np.uint64)
        kinds = np.array(rng.choices([0, 0, 0, 1, 2, 3], k=len(item)))
        kinds = kinds if rng.random() < 0.5 else kinds * (np.arange(len(item)) % 2)
        words = [rng.randrange(2000, 9000) for _ in range(30)]
        for w, kind in zip(item.tolist(), kinds.tolist()):
            words += {0: [w], 1: [rng.randrange(2000, 9000)], 2: [], 3: [rng.randrange(2000, 9000), w]}[kind]
        words += [rng.randrange(2000, 9000) for _ in range(30)]
        found = dc._found(item, np.array(words, np.uint64), 0.6, 13)
        if found:
            _, a, b, _ = found
            seeds, span, need = dc.bounds(len(item), 0.6, 13)
            pairs = {tuple(p) for p in zip(item.tolist(), item[1:].tolist())}
            hits = sum(p in pairs for p in zip(words[a:b], words[a + 1 : b]))
            assert b - a <= span and hits >= seeds and len({*words[a:b]} & {*item.tolist()}) + hits + 1 >= need
            reported += 1
    assert reported > 60


def test_rows_without_id_leave_by_their_own_text(spark):
    rng = random.Random(14)
    item = invented(rng, 30)
    clean = [" ".join(invented(rng, 60)) for _ in range(12)]
    rows = [(None if k < 8 else 5, t, "en", "s", 0) for k, t in enumerate(clean)] + [(i, " ".join([*invented(rng, 9), *item]), "en", "s", 0) for i in (None, 5)]
    kept = dc.without_benchmark(spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame([(1, " ".join(item))], ITEMS))
    assert sorted(r["text"] for r in kept.collect()) == sorted(clean)


def plain_leak(item, words, share=0.6, least=13):
    """The best alignment by score, equal words and start, cell by cell, and the longest run of equal words."""
    zero = lambda j: (0, 0, j)
    before, best, end, runs, run = [zero(j) for j in range(len(words) + 1)], (0, 0, 0), 0, [0] * (len(words) + 1), 0
    for w in item:
        now, own = [zero(0)], [0]
        for j in range(1, len(words) + 1):
            hit = words[j - 1] == w
            d = before[j - 1]
            moves = [(d[0] + (2 if hit else -1), d[1] + hit, d[2]), (before[j][0] - 1, *before[j][1:]), (now[-1][0] - 1, *now[-1][1:])]
            cell = max(moves)
            now.append(cell if cell[0] > 0 else zero(j))
            own.append(runs[j - 1] + 1 if hit else 0)
        before, runs = now, own
        run = max(run, *runs)
        if max(now) > best:
            best, end = max(now), now.index(max(now))
    score, equal, start = best
    return score / (2 * len(item)) >= share or (equal >= least and score >= 0.8 * 2 * (end - start)) or run >= least


def test_query_equals_brute_force(spark):
    rng = random.Random(31)
    items = [[rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 + str(rng.randint(0, 9)) for _ in range(rng.randint(6, 30))] for _ in range(5)]
    docs = []
    for i in range(70):
        words = [rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 40))]
        if i % 2:
            copy, rate = list(items[i % 5]), rng.random() * 0.5
            copy = [x for w in copy for x in ([w] if rng.random() > rate else rng.choice([[], [w, "new"], ["other"]]))]
            a, b = sorted((rng.randint(0, len(copy)), rng.randint(0, len(copy))))
            at = rng.randint(0, len(words))
            words[at:at] = copy if rng.random() < 0.7 else copy[a:b]
        docs.append((i, " ".join(words), "en", "s", 0))
    got = dc.contaminated(spark.createDataFrame(docs, DOCUMENTS), spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], ITEMS)).collect()
    want = {(d[0], k) for d in docs for k, w in enumerate(items) if plain_leak(w, d[1].split())}
    assert len(want) > 15 and {(r["doc_id"], r["item_id"]) for r in got} == want


def test_long_items_take_little_memory():
    import tracemalloc

    rng = np.random.default_rng(3)
    item, passage = rng.integers(0, 2**62, 1500).astype(np.uint64), rng.integers(0, 2**62, 6000).astype(np.uint64)
    passage[900:2400] = item
    tracemalloc.start()
    assert dc.align(item, passage) == (3000, 900, 2400, 1500)
    assert tracemalloc.get_traced_memory()[1] < 2 << 20
    tracemalloc.stop()
