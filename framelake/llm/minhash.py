"""SuperMinHash near-duplicates: banded signatures propose, shingle sets decide, union-find and stars group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .io import discard, join_small, null_ids, stored, table, with_ids
from .simhash import _by_key, _shingles, tiled
from .words import mix

#: A pair at similarity 0.85 shares none of the bands with probability 3e-7.
BANDS, ROWS = 32, 6
WORDS, PERCENT = 5, 85
#: Shingles whose ranks are drawn in one go, and texts with one table of minima.
SHINGLES_AT_ONCE, TEXTS_AT_ONCE = 1 << 16, 2048
#: Texts of a bucket compared in one go; larger buckets are cut into tiles, and every two tiles meet.
TILE = 1024
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def super_minhash(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash signatures: ``size`` values (rank << 32 | fraction) of every set.

    ``hashes`` has the sets one after the other, ``first`` where each begins and the end. An element draws a random permutation one
    place at a time (Fisher-Yates); at rank j it offers j plus a fraction to the place drawn. As ranks only grow, a set whose
    values are all below j is done before rank j: after about log(size) * size / elements ranks.
    """
    sets = len(first) - 1
    out = np.full(sets * size, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(sets), np.diff(first))
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        own, part = owner[at : at + SHINGLES_AT_ONCE], hashes[at : at + SHINGLES_AT_ONCE]
        places = np.tile(np.arange(size, dtype=np.min_scalar_type(size)), (len(part), 1))
        live = np.arange(len(part))
        for rank in range(size):
            low = int(own[live[0]])
            open_ = out[low * size : (int(own[live[-1]]) + 1) * size].reshape(-1, size).max(axis=1) >= np.uint64(rank) << np.uint64(32)
            live = live[open_[own[live] - low]]
            if not len(live):
                break
            with np.errstate(over="ignore"):
                draw = mix(part[live] + np.uint64(rank + 1) * _STEP)
            k = rank + (((draw >> np.uint64(32)) * np.uint64(size - rank)) >> np.uint64(32)).astype(np.int64)
            place = places[live, k]
            places[live, k] = places[live, rank]
            np.minimum.at(out, own[live] * size + place, (np.uint64(rank) << np.uint64(32)) | (draw & _LOW))
    return out.reshape(sets, size)


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of every signature; no key stands for two bands."""
    parts = signatures.reshape(len(signatures), bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _STEP
    with np.errstate(over="ignore"):
        for k in range(parts.shape[2]):
            key = mix(key * _STEP + parts[:, :, k])
    return key


def _prints(words: int, bands: int, rows: int):
    """doc_id, tk, n_shingles, node (hash of the set), band keys."""

    def made(batches) -> Iterator:
        import pandas as pd

        def flush(frame, sets):
            first = np.cumsum([0, *map(len, sets)])
            keys = band_keys(super_minhash(np.concatenate([*sets, np.empty(0, np.uint64)]), first, bands * rows), bands)
            node = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            return pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "tk": frame["tk"].to_numpy(), "n_shingles": np.diff(first), "node": node, "bands": [k.tobytes() for k in keys]})

        for batch in batches:
            held, start, size = [], 0, 0
            for i, found in enumerate(_shingles(batch["text"], words)):
                held.append(found)
                size += len(found)
                if len(held) == TEXTS_AT_ONCE or size >= 4 * SHINGLES_AT_ONCE:
                    yield flush(batch.iloc[start : i + 1], held)
                    held, start, size = [], i + 1, 0
            if held:
                yield flush(batch.iloc[start:], held)

    return made


def _buckets(batches) -> Iterator:
    import pandas as pd

    for batch in batches:
        keys = np.frombuffer(b"".join(batch["bands"]), np.int64)
        times = len(keys) // max(1, len(batch))
        yield pd.DataFrame({"bucket": keys, "node": np.repeat(batch["node"].to_numpy(), times), "n": np.repeat(batch["n"].to_numpy(), times)})


def _sets(words: int):
    def rows(batches) -> Iterator:
        for batch in batches:
            yield batch[["node"]].assign(shingles=[s.tobytes() for s in _shingles(batch["text"], words)])

    return rows


def _shared(one: np.ndarray, other: np.ndarray) -> int:
    """Common elements of two sorted sets."""
    return int((other[np.minimum(np.searchsorted(other, one), len(other) - 1)] == one).sum())


def _similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    both = _shared(one, other)
    return 100 * both >= percent * (len(one) + len(other) - both)


def _confirm(percent: int):
    """Pairs whose sets are similar."""

    def rows(batches) -> Iterator:
        for batch in batches:
            keep = [_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(batch["sa"], batch["sb"])]
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    return rows


class Union:
    """Union-find over the given names, with path halving."""

    def __init__(self, names):
        self.up = {x: x for x in names}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _linked(percent: int):
    """For batches sorted by bucket and tiles: links between texts of a bucket that are not in one group yet."""
    keys = ["bucket", "lo", "hi"]

    def made(frame):
        import pandas as pd

        links = []
        for _, x in frame.groupby(keys, sort=False):
            x = x.sort_values("n")
            sets, n, node, root = [np.frombuffer(s, np.uint64) for s in x["shingles"]], x["n"].to_numpy(), x["node"].to_numpy(), x["root"].to_numpy()
            groups = Union(root.tolist())
            open_ = len(groups.up)
            for i in range(len(x)):
                reach = int(np.searchsorted(n, n[i] * 100 // percent, "right"))
                for j in range(i + 1, reach):
                    if open_ > 1 and groups.find(root[i]) != groups.find(root[j]) and _similar(sets[i], sets[j], percent):
                        groups.join(root[i], root[j])
                        links.append((node[i], node[j]))
                        open_ -= 1
                if open_ == 1:
                    break
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return _by_key(keys, made)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for other in frames[1:]:
        out = out.union(other)
    return out


def _links(members: DataFrame, sets: DataFrame, percent: int, tile: int) -> DataFrame:
    """Links that connect what is connected, as a stored table; ``members`` (bucket, node, n) are stored, in buckets of two or more.

    Turns: every member is held against one representative of its bucket, another one each turn. Buckets whose members are in one group
    by then are closed, and so are those of two. When a turn closes less than half of what is open, all pairs of different groups in
    the open buckets meet, tile by tile.
    """
    open_, turn, found = members.withColumn("root", F.col("node")), 0, []
    before = members.count()
    made = []
    while before:
        chosen = F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), F.col("node").alias("rep"), F.col("n").alias("m"), F.col("root").alias("other"))).alias("x")
        reps = stored(open_.groupBy("bucket").agg(chosen).select("bucket", "x.rep", "x.m", "x.other"), "minhash-reps")
        near = (F.col("root") != F.col("other")) & (F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
        pairs = open_.join(reps.hint("merge"), "bucket").where(near).select(F.least("node", "rep").alias("a"), F.greatest("node", "rep").alias("b")).distinct()
        pairs = stored(pairs, "minhash-pairs")
        with_a = stored(pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")).hint("merge"), "a"), "minhash-left")
        both = with_a.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")).hint("merge"), "b").select("a", "b", "sa", "sb")
        found.append(stored(both.mapInPandas(_confirm(percent), "a long, b long"), "minhash-links"))
        roots = components(_union(found))
        placed = open_.drop("root").join(roots.hint("merge"), F.col("node") == roots["u"], "left").select("bucket", "node", "n", F.coalesce("root", "node").alias("root"))
        placed = stored(placed, "minhash-placed")
        # buckets of the same members are one; two members have met
        kinds = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.min("root").alias("least"), F.max("root").alias("most"), F.bit_xor(F.xxhash64("node")).alias("sign"))
        still = kinds.where("k > 2 and least < most").groupBy("k", "sign").agg(F.min("bucket").alias("bucket"))
        still = stored(still.select("bucket", "k"), "minhash-open")
        last = stored(placed.join(still.hint("merge"), "bucket").select("bucket", "node", "n", "root", "k"), "minhash-rest")
        for done in (reps, pairs, with_a, roots, placed, still, *made):
            discard(done)
        made, turn, now = [last], turn + 1, last.count()
        open_ = last.drop("k")
        if now * 2 > before:
            met = tiled(last.select("bucket", "node", F.col("k").alias("n")), "bucket", "node", tile)
            told = stored(last.select("node", "n", "root").distinct().join(sets.hint("merge"), "node"), "minhash-told")
            order = ["bucket", "lo", "hi"]
            met = met.join(told.hint("merge"), "node").repartition(*[F.col(c) for c in order]).sortWithinPartitions(*order)
            found.append(stored(met.select(*order, "node", "n", "root", "shingles").mapInPandas(_linked(percent), "a long, b long").distinct(), "minhash-links"))
            discard(told)
            now = 0
        before = now
    for done in made:
        discard(done)
    none = members.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    out = stored(_union(found or [none]), "minhash-all")
    for done in found:
        discard(done)
    return out


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the group), kept (whether the row has that id) of every row.

    Texts are linked if their sets of shingles have 100 * intersection >= ``percent`` * union. Equal sets meet once, as one node. A text
    under ``words`` words is one shingle; null, empty and blank texts have an empty set and are groups of their own. Rows without an id
    belong to their group but never name it; a group of such rows only is named by null, and all of them are kept. Very long texts are read whole; repeated
    rows get equal answers; other columns are left out; an empty table gives no rows.
    """
    ids = with_ids(docs, "doc_id", F.xxhash64("text").alias("tk"), "text")
    prints = stored(null_ids(ids.mapInPandas(_prints(words, bands, rows), "doc_id long, tk long, n_shingles long, node long, bands binary"), "doc_id"), "minhash-docs")
    nodes = prints.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.min("tk").alias("tk"), F.min("n_shingles").alias("n"), F.first("bands").alias("bands"))
    nodes = stored(nodes, "minhash-nodes")
    keyed = nodes.select("node", "n", "bands").mapInPandas(_buckets, "bucket long, node long, n long")
    counts = stored(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("bucket"), "minhash-buckets")
    members = stored(keyed.join(counts.hint("merge"), "bucket").select("bucket", "node", "n"), "minhash-members")
    some = stored(members.select("node").distinct(), "minhash-some")
    wanted = stored(nodes.select("node", "tk").join(some.hint("merge"), "node", "left_semi"), "minhash-wanted")
    texts = join_small(docs.select(F.xxhash64("text").alias("tk"), "text"), wanted, "tk", "inner").select("node", "text").dropDuplicates(["node"])
    sets = stored(texts.mapInPandas(_sets(words), "node long, shingles binary"), "minhash-sets")
    links = _links(members, sets, percent, tile)
    roots = components(links)
    rooted = stored(nodes.join(roots.hint("merge"), nodes["node"] == roots["u"], "left").select("node", "least", F.coalesce("root", "node").alias("root")), "minhash-rooted")
    named = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "minhash-names")
    by_node = stored(rooted.join(named.hint("merge"), "root").select("node", "component_id"), "minhash-named")
    for done in (nodes, counts, members, some, wanted, sets, links, roots, rooted, named):
        discard(done)
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = prints.join(by_node.hint("merge"), "node", "left").select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def query(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT rid, array_to_string(ws[i:i + 4], ' ') AS sh FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS m FROM s a JOIN s b USING (sh) WHERE a.rid <> b.rid GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
r AS (SELECT rid AS a, rid AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT r.a AS rid, min(w.doc_id) AS component_id FROM r JOIN w ON w.rid = r.b GROUP BY r.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, w.doc_id IS NOT DISTINCT FROM c.component_id AS kept FROM w JOIN c USING (rid) LEFT JOIN n USING (rid)
"""
