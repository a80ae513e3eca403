"""Removal of word passages that occur elsewhere, through FM-indexes of content-defined shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fmindex import repeated_windows
from .io import NO_ID, discard, join_small, null_ids, stored, table
from .words import Words, chunks, encoded, gram_hashes, minimizer_runs, white_space

WINDOW = 35
#: Words of the gram whose smallest hash within a window names the window's shard key.
GRAM = 8
#: Words of one FM-index, at most one key more.
SHARD_WORDS = 300_000
#: Different segments of one key in one FM-index; a key with more is dealt out by its windows.
KEY_SEGMENTS = 4096


def _keys(window: int, gram: int):
    def rows(batches) -> Iterator:
        import pandas as pd

        for batch in batches:
            texts = [encoded(t) for t in batch["text"]]
            did, tk = batch["did"].to_numpy(), batch["tk"].to_numpy()
            for a, b in chunks(texts):
                words = Words(texts[a:b], white_space())
                first, _, key, inner = minimizer_runs(words.hashes, words.first, window, gram)
                row = np.searchsorted(words.first, first, side="right") - 1 + a
                found = pd.DataFrame({"did": did[row], "tk": tk[row], "key": key.view(np.int64), "n": 1 + inner})
                yield found.groupby(["did", "tk", "key"], sort=False, as_index=False)["n"].sum()

    return rows


def _segments(window: int, gram: int):
    """Segments of the runs whose key is in the row's list: the run's windows and no other lie in it whole."""

    def rows(batches) -> Iterator:
        import pandas as pd

        for batch in batches:
            texts = [encoded(t) for t in batch["text"]]
            out = []
            for a, b in chunks(texts):
                words = Words(texts[a:b], white_space())
                first, count, key, _ = minimizer_runs(words.hashes, words.first, window, gram)
                key = key.view(np.int64)
                row = np.searchsorted(words.first, first, side="right") - 1
                cut = np.searchsorted(row, np.arange(b - a + 1))
                for i in range(b - a):
                    own = slice(cut[i], cut[i + 1])
                    for j in np.flatnonzero(np.isin(key[own], batch["keys"].iat[a + i])) + cut[i]:
                        p = int(first[j])
                        out.append((batch["did"].iat[a + i], batch["tk"].iat[a + i], key[j], p - int(words.first[i]), words.text(p, p + int(count[j]) + window - 1)))
            yield pd.DataFrame(out, columns=["did", "tk", "key", "start", "body"])

    return rows


def _windows(window: int):
    """Every window of a segment as a segment of its own, whose key is the window's hash."""

    def rows(batches) -> Iterator:
        import pandas as pd

        for batch in batches:
            out = []
            for sd, body, n in zip(batch["sd"], batch["body"], batch["n"]):
                words = Words([body], white_space())
                keys = gram_hashes(words.hashes, window).view(np.int64).tolist()
                out += [(key, sd, at, n, words.text(at, at + window)) for at, key in enumerate(keys)]
            yield pd.DataFrame(out, columns=["key", "whole", "at", "n", "body"])

    return rows


def _index_shards(window: int, shard_words: int):
    """For different segments sorted by key: an FM-index over those of neighbouring keys, through which they are streamed."""

    def rows(batches) -> Iterator:
        import pandas as pd

        def search(frame) -> pd.DataFrame:
            split = [x.split(b" ") for x in frame["body"]]
            lengths = np.array([len(x) for x in split])
            lone = frame["n"].to_numpy() == 1
            masks = np.where(lone, 0, (1 << (lengths - window + 1)) - 1)
            # a key with one segment has nothing to compare it with but the segment itself
            alone = frame.groupby("key")["key"].transform("size").to_numpy() == 1
            used = np.flatnonzero(~alone | (lone & (lengths > window)))
            if len(used) and lone[used].any():
                ids = pd.factorize(np.array([w for i in used for w in split[i]], object))[0].astype(np.int64) + 2
                masks[used] = repeated_windows(np.split(ids, np.cumsum(lengths[used])[:-1]), lone[used], window)
            return frame[["key", "sd"]].assign(mask=masks).query("mask != 0")

        held, size = [], 0
        for batch in batches:
            keys = batch["key"].to_numpy()
            words = np.array([x.count(b" ") + 1 for x in batch["body"]])
            last = 0
            for cut in [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1), None]:
                part = slice(last, cut)
                if cut is not None and size + int(words[part].sum()) < shard_words:
                    size += int(words[part].sum())
                    held.append(batch.iloc[part])
                elif cut is None:
                    size += int(words[part].sum())
                    held.append(batch.iloc[part])
                else:
                    yield search(pd.concat([*held, batch.iloc[part]], ignore_index=True))
                    held, size = [], 0
                last = cut
        if held:
            yield search(pd.concat(held, ignore_index=True))

    return rows


def _cleaned(window: int):
    def rows(batches) -> Iterator:
        import pandas as pd

        for batch in batches:
            out = []
            for text, found in zip(batch["text"], batch["found"]):
                words = encoded(text).split()
                kept = words
                if found is not None and len(found):
                    step = np.zeros(len(words) + 1, np.int32)
                    for x in found:
                        mask = int(x["mask"])
                        starts = x["start"] + np.flatnonzero([(mask >> i) & 1 for i in range(mask.bit_length())])
                        np.add.at(step, starts, 1)
                        np.add.at(step, starts + window, -1)
                    kept = [w for w, c in zip(words, np.cumsum(step[:-1]).tolist()) if not c]
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame({"doc_id": batch["doc_id"]}).join(pd.DataFrame(out, columns=["n_words", "n_removed", "kept"]))

    return rows


def repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS, key_segments: int = KEY_SEGMENTS) -> DataFrame:
    """(did, tk, start, mask), stored: windows that occur at more than one place, as bits from word ``start`` of a text.

    1. Every text is cut into runs of windows with the same smallest gram hash, the key. Equal windows have equal keys,
       so only keys that occur twice can hold repeated windows. Keys are counted over all documents.
    2. The segments of such keys are reduced to different ones with their number of copies, by partial aggregation, and go to
       their key's shard. A shard is an FM-index over a wavelet matrix, through which its segments are streamed by backward search.
    3. A key with more different segments than an index should hold is dealt out by its windows first: each is a segment whose
       key is its own hash; those that occur twice go through shards in the same way.
    """

    def indexed(kinds: DataFrame, label: str) -> DataFrame:
        own = kinds.select("key", "sd", "body", "n").repartition("key").sortWithinPartitions("key")
        return stored(own.mapInPandas(_index_shards(window, shard_words), "key long, sd string, mask long"), label)

    found = stored(docs.mapInPandas(_keys(window, gram), "did long, tk long, key long, n int"), "substring-keys")
    twice = stored(found.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"), "substring-twice")
    own = found.select("did", "tk", "key").distinct().join(twice.hint("merge"), "key").groupBy("did", "tk").agg(F.collect_list("key").alias("keys"))
    picked = docs.join(own.hint("merge"), ["did", "tk"]).select("did", "tk", "text", "keys")
    # rows that are equal in doc_id and text stay apart here, so that each is an occurrence of its own
    parts = picked.mapInPandas(_segments(window, gram), "did long, tk long, key long, start int, body binary")
    parts = stored(parts.withColumn("sd", F.md5("body")), "substring-segments")
    discard(found)
    discard(twice)
    kinds = stored(parts.groupBy("key", "sd").agg(F.first("body").alias("body"), F.count(F.lit(1)).alias("n")), "substring-kinds")
    places = stored(parts.select("did", "tk", "start", "sd").distinct(), "substring-places")
    discard(parts)
    large = stored(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > key_segments).select("key"), "substring-large")
    masks = indexed(join_small(kinds, large, "key", "left_anti"), "substring-masks")
    made = [kinds, large, masks, places]
    if large.take(1):
        cut = join_small(kinds, large, "key", "left_semi").mapInPandas(_windows(window), "key long, whole string, at int, n long, body binary")
        again = stored(cut.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"), "substring-again")
        cut = stored(cut.join(again.hint("merge"), "key", "left_semi").withColumn("sd", F.md5("body")), "substring-windows")
        hits = indexed(cut.groupBy("key", "sd").agg(F.first("body").alias("body"), F.sum("n").alias("n")), "substring-hits")
        more = cut.join(hits.select("key", "sd").hint("merge"), ["key", "sd"]).groupBy(F.col("whole").alias("sd")).agg(F.expr("bit_or(shiftleft(1L, at))").alias("mask"))
        masks = stored(masks.select("sd", "mask").union(more), "substring-all")
        made += [again, cut, hits, masks]
    # a segment's words tell its key, so its digest alone names it
    spans = stored(places.join(masks.select("sd", "mask").hint("merge"), "sd").select("did", "tk", "start", "mask"), "substring-repeated")
    for part in made:
        discard(part)
    return spans


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) of every row.

    A word goes if a window of 35 words that covers it occurs at another place, in the same text or another. Null text has
    no words; texts under 35 words stay whole; equal rows are copies of each other; an empty table gives no rows.
    """
    keyed = docs.select("text", F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), F.xxhash64("text").alias("tk"))
    found = repeated(keyed.select("did", "tk", "text"), **options)
    spans = stored(found.groupBy("did", "tk").agg(F.collect_list(F.struct("start", "mask")).alias("found")), "substring-spans")
    discard(found)
    merged = keyed.join(spans.hint("merge"), ["did", "tk"], "left").select(F.col("did").alias("doc_id"), "text", "found")
    return null_ids(merged.mapInPandas(_cleaned(options.get("window", WINDOW)), "doc_id long, n_words long, n_removed long, kept string"), "doc_id")


def query(spark, sf_dir):
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT rid, i, array_to_string(ws[i:i + 34], ' ') AS win FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY win) AS n FROM p) WHERE n > 1),
c AS (SELECT DISTINCT rid, i + k AS i FROM r, (SELECT unnest(range(0, 35)) AS k)),
e AS (SELECT rid, doc_id, len(ws) AS n, ws, unnest(CASE WHEN len(ws) = 0 THEN [0] ELSE range(1, len(ws) + 1) END) AS i FROM w),
k AS (SELECT e.rid, e.doc_id, e.n, count(c.i) AS removed, coalesce(string_agg(CASE WHEN c.i IS NULL AND e.i > 0 THEN ws[e.i] END, ' ' ORDER BY e.i), '') AS kept
      FROM e LEFT JOIN c ON c.rid = e.rid AND c.i = e.i GROUP BY e.rid, e.doc_id, e.n)
SELECT doc_id, n::BIGINT AS n_words, removed::BIGINT AS n_removed, sha256(kept) AS kept_sha256 FROM k
"""
