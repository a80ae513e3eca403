"""Benchmark decontamination: pairs of words seed stretches of a document, local alignment scores them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .io import NO_ID, discard, keep_rows, null_ids, stored, table, with_ids
from .words import Words, chunks, encoded, gram_hashes, not_alphanumeric

#: Words of a seed.
SEED_WORDS = 2
#: Items with fewer words are never reported.
LEAST_ITEM = 4
#: Alignment scores: equal words, different words, one word more or less.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Reported: this share of the best possible score of the item, or a run of this many equal words.
LEAST_SHARE, LEAST_WORDS = 0.6, 13
#: An alignment with LEAST_WORDS equal words is also reported at this share of the best score of its own stretch.
DENSE = 0.8
#: Seeds of the benchmark that a task holds at once; a larger benchmark is taken in parts, with a scan for each.
SEEDS_AT_ONCE = 4_000_000
#: (seed, item) pairs that a task expands at once, beyond a single document.
PAIRS_AT_ONCE = 2_000_000


def _lowered(text: str | None) -> bytes:
    return encoded(text.lower()) if text else b""


def item_words(items: DataFrame) -> DataFrame:
    """(item_id, item, n): the items' words as hashes, and their number."""

    def rows(batches) -> Iterator:
        import pandas as pd

        for batch in batches:
            hashes = [Words([_lowered(text)], not_alphanumeric()).hashes for text in batch["text"]]
            yield pd.DataFrame({"item_id": batch["item_id"], "item": [h.tobytes() for h in hashes], "n": [len(h) for h in hashes]})

    return items.select(F.coalesce("item_id", F.lit(NO_ID)).alias("item_id"), "text").mapInPandas(rows, "item_id long, item binary, n int")


def bounds(m: int, share: float, least: int) -> tuple[int, int, float]:
    """What every reported alignment with an item of m words has: seeds, passage words at most, equal words + seeds + 1.

    M equal words and E others score 2M - E and lie in at most E + 1 runs, so they hold at least M - E - 1 seeds and
    score at most M + seeds + 1. At a share s of 2m that leaves (2s - 1)m - 1 seeds in at most (3 - 2s)m words; a dense
    stretch of ``least`` equal words has E <= 0.4M.
    """
    dense = math.ceil((2 * DENSE - 1) * least - 1 - 1e-9)
    seeds = max(1, min(math.ceil((2 * share - 1) * m - 1 - 1e-9), dense))
    return seeds, math.ceil((3 - 2 * share) * m) + 1, min(MATCH * share * m - 1e-9, least + dense + 1)


def _index(ids: np.ndarray, items: list[np.ndarray], share: float, least: int) -> dict:
    """Seeds of these items, sorted, with the items of each.

    An item that needs t seeds may do without its t // 2 commonest ones: t - t // 2 of the others are there all the same.
    """
    grams = [gram_hashes(x, SEED_WORDS) for x in items]
    kinds, times = np.unique(np.concatenate([np.unique(g) for g in grams]), return_counts=True)
    limits = [bounds(len(x), share, least) for x in items]
    kept = []
    for g, (seeds, _, _) in zip(grams, limits):
        order = np.argsort(times[np.searchsorted(kinds, g)], kind="stable")
        kept.append(np.unique(g[order[: len(g) - seeds // 2]]))
    gram, owner = np.concatenate(kept), np.repeat(np.arange(len(kept), dtype=np.int32), [len(k) for k in kept])
    order = np.argsort(gram, kind="stable")
    known, first = np.unique(gram[order], return_index=True)
    return {
        "ids": ids, "items": items, "known": known, "first": np.append(first, len(gram)), "owner": owner[order],
        "hits": np.array([s - s // 2 for s, _, _ in limits]), "span": np.array([w for _, w, _ in limits]), "need": [x for _, _, x in limits],
    }


#: A cell holds score, equal words and start in one number, so that a maximum compares them in this order.
_SCORE, _EQUAL = 42, 21


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int, int]:
    """Smith-Waterman over words: (score, first word, end word, equal words) of the best local alignment.

    Of equal scores that with more equal words, then the later start. Only one row of the table is held: every cell
    carries the start and the equal words of its alignment, so memory grows with the passage alone.
    """
    places = np.arange(len(passage) + 1, dtype=np.int64)  # an empty alignment that starts here
    ramp, hit = (-GAP * places) << _SCORE, (MATCH << _SCORE) + (1 << _EQUAL)
    row, best, end = places, 0, 0
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, hit, MISMATCH << _SCORE)
        row = np.maximum.accumulate(np.append(0, np.maximum(diagonal, row[1:] + (GAP << _SCORE))) + ramp) - ramp
        row = np.where(row < 1 << _SCORE, places, row)
        if (top := int(row.max())) > best:
            best, end = top, int(row.argmax())
    if best < 1 << _SCORE:
        return 0, 0, 0, 0
    return best >> _SCORE, best & ((1 << _EQUAL) - 1), end, (best >> _EQUAL) & ((1 << _EQUAL) - 1)


def _stretches(words: Words, grams: np.ndarray, index: dict) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first word, end word) of all stretches that hold the seeds an item needs, close enough together."""
    known, first = index["known"], index["first"]
    where = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    at = np.flatnonzero(known[where] == grams)
    row = np.searchsorted(words.first, at, side="right") - 1
    inside = at + SEED_WORDS <= words.first[row + 1]
    at, row = at[inside], row[inside]
    if not len(at):
        return
    begin = first[where[at]]
    count = first[where[at] + 1] - begin
    texts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    bucket = (np.cumsum(count) - count)[texts] // PAIRS_AT_ONCE
    cuts = texts[np.concatenate([[True], bucket[1:] != bucket[:-1]])]
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)]):
        n = count[a:b]
        item = index["owner"][np.repeat(begin[a:b] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        order = np.argsort(item, kind="stable")  # places stay in order within an item
        item, pos, text = item[order], np.repeat(at[a:b], n)[order], np.repeat(row[a:b], n)[order]
        last = np.arange(len(item)) + index["hits"][item] - 1
        fits = np.flatnonzero(last < len(item))
        last, span = last[fits], index["span"][item[fits]]
        near = (item[last] == item[fits]) & (text[last] == text[fits]) & (pos[last] + SEED_WORDS - pos[fits] <= span)
        item, text, lo, hi = item[fits][near], text[fits][near], (pos[last] + SEED_WORDS - span)[near], (pos[fits] + span)[near]
        if not len(item):
            continue
        lo, hi = np.maximum(lo, words.first[text]), np.minimum(hi, words.first[text + 1])
        new = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (lo[1:] > hi[:-1])]))
        yield from zip(text[new].tolist(), item[new].tolist(), lo[new].tolist(), hi[np.append(new[1:], len(item)) - 1].tolist())


def _among(values: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Running count of the values that are among these sorted kinds."""
    hit = kinds[np.minimum(np.searchsorted(kinds, values), len(kinds) - 1)] == values
    return np.concatenate([[0], np.cumsum(hit)])


def longest_run(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """(words, end word in the passage) of the longest run of equal words."""
    now, best, end = np.zeros(len(passage) + 1, np.int32), 0, 0
    for word in item:
        now[1:] = np.where(passage == word, now[:-1] + 1, 0)
        if (top := int(now.max())) > best:
            best, end = top, int(now.argmax())
    return best, end


def _found(item: np.ndarray, passage: np.ndarray, share: float, least: int) -> tuple[float, int, int, int] | None:
    """(score, first word, end word, equal words) of the best alignment, or else of the longest run, if it is a leak."""
    score, a, b, equal = align(item, passage)
    whole = MATCH * len(item)
    if score / whole >= share or (equal >= least and score >= DENSE * MATCH * (b - a)):
        return score / whole, a, b, equal
    run, end = longest_run(item, passage)
    return (MATCH * run / whole, end - run, end, run) if run >= least else None


def _text_leaks(texts: list[str | None], known: dict, share: float, least: int) -> Iterator[tuple]:
    """(text, item, first word, end word, score, equal words, item words) of all leaks; ``kinds`` of ``known`` keeps what was prepared."""
    texts, kinds = [_lowered(t) for t in texts], known["kinds"]
    for a, b in chunks(texts):
        words = Words(texts[a:b], not_alphanumeric())
        grams = gram_hashes(words.hashes, SEED_WORDS)
        for r, k, lo, hi in _stretches(words, grams, known) if len(grams) else ():
            item, span = known["items"][k], int(known["span"][k])
            if k not in kinds:
                kinds[k] = np.unique(item), np.unique(gram_hashes(item, SEED_WORDS))
            equal, seeds = _among(words.hashes[lo:hi], kinds[k][0]), _among(grams[lo : hi - SEED_WORDS + 1], kinds[k][1])
            wide, pairs = min(span, hi - lo), min(span, hi - lo) - SEED_WORDS + 1
            most = np.minimum(equal[wide:] - equal[:-wide], len(item)) + seeds[pairs:] - seeds[:-pairs] + 1
            done = -1
            for x in np.flatnonzero(most >= known["need"][k]).tolist():  # tiles of two spans: every alignment lies in one of them
                if x < done:
                    continue
                start, end = lo + x, min(hi, lo + x + 2 * span)
                done = x + span
                if found := _found(item, words.hashes[start:end], share, least):
                    score, f, e, same = found
                    start -= words.first[r]
                    yield a + r, known["ids"][k], int(start + f), int(start + e), float(score), same, len(item)


def _indexes(items: DataFrame, share: float, least: int, at_once: int) -> Iterator:
    """Broadcast indexes of the benchmark's seeds, of about ``at_once`` words each: one, unless the benchmark is very large."""
    spark = items.sparkSession
    known = stored(item_words(items).where(F.col("n") >= LEAST_ITEM), "benchmark-items")
    parts = max(1, -(-(known.agg(F.sum("n")).first()[0] or 0) // at_once))
    for part in range(parts):
        own = known.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(parts)) == part).toPandas()
        if len(own):
            index = _index(own["item_id"].to_numpy(np.int64), [np.frombuffer(x, np.uint64) for x in own["item"]], share, least)
            yield spark.sparkContext.broadcast({**index, "kinds": {}})
    discard(known)


def contaminated(docs: DataFrame, items: DataFrame, share: float = LEAST_SHARE, least: int = LEAST_WORDS, at_once: int = SEEDS_AT_ONCE) -> DataFrame:
    """doc_id, item_id, first_word, end_word, score, equal_words, item_words of every document and item found in it.

    Words are lower-cased runs of letters and digits. One row per document and item, that of the best score; clean
    documents have none. Null and empty texts, and items of fewer than LEAST_ITEM words, never match. Rows that share a doc_id
    are reported together; a null doc_id is kept. A document is found if its best alignment with an item reaches ``share``, or if
    it holds a run of ``least`` equal words; seeds only leave out stretches that cannot. (Exempt are items of four or five words with
    new words between all of theirs, and a ``share`` near 0.5 or below: their alignments may hold no two neighbouring words.)
    """
    def leaks(index):
        def rows(batches) -> Iterator:
            import pandas as pd

            for batch in batches:
                found = list(_text_leaks(batch["text"].tolist(), index.value, share, least))
                out = pd.DataFrame(found, columns=["doc_id", "item_id", "first_word", "end_word", "score", "equal_words", "item_words"])
                yield out.assign(doc_id=batch["doc_id"].to_numpy()[out["doc_id"].to_numpy(np.int64)])

        return rows

    schema = "doc_id long, item_id long, first_word int, end_word int, score double, equal_words int, item_words int"
    found = docs.sparkSession.createDataFrame([], schema)
    for index in _indexes(items, share, least, at_once):
        found = found.union(with_ids(docs, "doc_id", "text").mapInPandas(leaks(index), schema))
    best = F.max(F.struct("score", "equal_words", -F.col("first_word"), "first_word", "end_word", "item_words")).alias("b")
    out = found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.first_word", "b.end_word", "b.score", "b.equal_words", "b.item_words")
    return null_ids(null_ids(out, "doc_id"), "item_id")


def without_benchmark(docs: DataFrame, items: DataFrame, share: float = LEAST_SHARE, least: int = LEAST_WORDS, at_once: int = SEEDS_AT_ONCE) -> DataFrame:
    """The rows of ``docs`` in which no item is found, as they stand.

    Every row is judged by its own text where it is read, so rows of one doc_id, or of none, never decide for each other, and
    nothing is shuffled. Null and empty texts stay; repeated rows stay or go together; an empty table gives no rows."""

    def clean(index):
        def test(texts: list[str | None]) -> np.ndarray:
            out = np.ones(len(texts), bool)
            for at, *_ in _text_leaks(texts, index.value, share, least):
                out[at] = False
            return out

        return test

    for index in _indexes(items, share, least, at_once):
        docs = keep_rows(docs, "text", clean(index))
    return docs


def query(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
