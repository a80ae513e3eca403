"""SimHash near-duplicates: shared blocks propose pairs, the Hamming distance decides, links form groups."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .io import NO_ID, discard, join_small, null_ids, stored, table, with_ids
from .words import Words, chunks, encoded, gram_hashes, mix, white_space

#: 64 bits in this many blocks; fingerprints within MAX_BITS share at least BLOCKS - MAX_BITS whole blocks.
BLOCKS, MAX_BITS = 7, 4
#: Fingerprints compared in one go; larger buckets are cut into tiles, and every two tiles meet.
TILE = 4096


def fingerprint(text: str | None, words: int = 4) -> int:
    """64-bit SimHash over the XXH64 hashes (seed 42) of all shingles; 0 if the text has no word."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes.lower: A-Z only
    if not tokens:
        return 0
    body = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    m = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    last = ends[words - 1 :].tolist() if len(tokens) >= words else [len(body)]
    total = np.zeros(64, np.int64)
    hashes = np.array([digest(body[a:b], 42) for a, b in zip(starts[:m].tolist(), last)], np.uint64)
    for at in range(0, m, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        total += np.add.reduce(np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(total * 2 > m, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id, fp (as a signed long) of every row."""

    def rows(batches):
        for batch in batches:
            values = np.array([fingerprint(t, words) for t in batch["text"]], np.uint64)
            yield batch[["doc_id"]].assign(fp=values.view(np.int64))

    return null_ids(with_ids(docs, "doc_id", "text").mapInPandas(rows, "doc_id long, fp long"), "doc_id")


def block_masks(blocks: int = BLOCKS, bits: int = MAX_BITS) -> list[int]:
    """A mask for every choice of blocks - bits blocks: fingerprints within ``bits`` agree under one of them."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _forest(fps: np.ndarray, bits: int) -> list[tuple[np.ndarray, int]]:
    """Links that connect what is connected within one bucket: (members, a linked member), breadth first."""
    out, rest = [], fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            hit = np.bitwise_count(rest ^ x) <= bits
            if hit.any():
                out.append((found := rest[hit], x))
                queue.extend(found)
                rest = rest[~hit]
    return out


def _by_key(keys: list[str], made):
    """For batches sorted by these columns: ``made`` over frames that hold whole groups."""

    def rows(batches) -> Iterator:
        import pandas as pd

        held = None
        for batch in batches:
            frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
            ids = frame[keys].to_numpy()
            same = (ids == ids[-1]).all(axis=1)
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = frame.iloc[cut:]
            if cut:
                yield made(frame.iloc[:cut])
        if held is not None and len(held):
            yield made(held)

    return rows


def _links(bits: int):
    """For batches sorted by bucket and tiles: spanning links of every bucket, or of two tiles of one."""
    keys = ["bucket", "lo", "hi"]

    def made(frame):
        import pandas as pd

        fps = frame["fp"].to_numpy().view(np.uint64)
        ids = frame[keys].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(axis=1)]))
        size = np.diff(np.append(starts, len(fps)))
        two = starts[size == 2]  # most buckets: all at once
        near = np.bitwise_count(fps[two] ^ fps[two + 1]) <= bits
        a, b = [fps[two][near]], [fps[two + 1][near]]
        for s, n in zip(starts[size > 2].tolist(), size[size > 2].tolist()):
            for members, x in _forest(fps[s : s + n], bits):
                a.append(members)
                b.append(np.full(len(members), x))
        return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)}).drop_duplicates()

    return _by_key(keys, made)


def tiled(members: DataFrame, bucket: str, member: str, tile: int) -> DataFrame:
    """(bucket, lo, hi, member) for members (bucket, member, n) of buckets with n rows: every two members of a bucket meet.

    Buckets above ``tile`` rows are dealt into tiles of about half that size by a hash of the member, and every two tiles are a
    unit of work of their own, so memory stays bounded and no comparison is left out.
    """
    half = tile // 2
    tiles = F.when(F.col("n") > tile, F.ceil(F.col("n") / half)).otherwise(F.lit(1)).cast("int")
    own = members.select(bucket, member, tiles.alias("tiles")).withColumn("own", F.pmod(F.xxhash64(F.lit("tile"), member), "tiles").cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return met.select(bucket, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), member)


def near_links(nodes: DataFrame, blocks: int = BLOCKS, bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints within ``bits``: as many as keep connected what is connected.

    A bucket holds the fingerprints that agree under one mask. Buckets are counted first, by partial aggregation, so that those
    of one row end there; the others meet by a join on the bucket that adaptive execution can split. No pair table is made: a
    task walks its bucket, or two tiles of a large one, and emits fewer links than it has rows.
    """
    buckets = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(block_masks(blocks, bits))])
    keyed = nodes.select("fp", F.explode(buckets).alias("bucket"))
    counts = stored(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-buckets")
    met = tiled(keyed.join(counts.hint("merge"), "bucket"), "bucket", "fp", tile)
    order = ["bucket", "lo", "hi"]
    met = met.repartition(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    links = stored(met.mapInPandas(_links(bits), "a long, b long").distinct(), "simhash-links")
    discard(counts)
    return links


def near_duplicates(docs: DataFrame, words: int = 4, blocks: int = BLOCKS, bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the group) of every row.

    Equal fingerprints meet once; texts without a word (null, empty, white space) have fingerprint zero and link like any
    other. Rows with a null doc_id belong to their group but never name it. Very long texts are read whole; repeated rows get
    equal answers; other columns are left out; an empty table gives no rows.
    """
    prints = stored(fingerprints(docs, words), "simhash-docs")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    links = near_links(nodes, blocks, bits, tile)
    roots = components(links)
    rooted = nodes.join(roots.hint("merge"), nodes["fp"] == roots["u"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "simhash-rooted")
    for done in (nodes, links, roots):
        discard(done)
    # aggregates are written before they are joined, so that both sides come from a shuffle and hot keys can be split
    named = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-names")
    by_print = stored(rooted.join(named.hint("merge"), "root").select("fp", "component_id"), "simhash-named")
    discard(rooted)
    discard(named)
    return prints.join(by_print.hint("merge"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Wide fingerprints: BLOCK_COUNT blocks of 24 bits, of which 22 are a bucket's key. At a shingle similarity of 0.8 about 15 % of the bits differ.
BLOCK_COUNT, BLOCK_BYTES, SPARE_BITS = 128, 3, 2
#: Two texts alone in a bucket are first compared by the spare bits of this many blocks.
SKETCH_BLOCKS = 16
_STEP = np.uint64(0x9E3779B97F4A7C15)


def wide_bits(similarity: float, total: int = BLOCK_COUNT * BLOCK_BYTES * 8) -> int:
    """Differing bits at this Jaccard similarity at most: those expected (the angle between two sets of equal size), and four deviations."""
    share = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    return int(np.ceil(total * share + 4 * (total * share * (1 - share)) ** 0.5))


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """SimHash of BLOCK_COUNT * 24 bits over a set of shingle hashes."""
    words = BLOCK_COUNT * BLOCK_BYTES // 8
    total = np.zeros(words * 64, np.int64)
    for at in range(0, len(hashes), 255):  # sums of up to 255 bits fit in a byte
        with np.errstate(over="ignore"):
            each = mix(hashes[at : at + 255, None] + np.arange(words, dtype=np.uint64) * _STEP)
        total += np.add.reduce(np.unpackbits(each.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(total * 2 > len(hashes), bitorder="little").tobytes()


def _shingles(texts: list, words: int) -> Iterator[np.ndarray]:
    """The sorted set of every text's shingle hashes; A-Z are lower-cased."""
    texts = [encoded(t).lower() for t in texts]
    for a, b in chunks(texts):
        found = Words(texts[a:b], white_space())
        for i in range(b - a):
            own = found.hashes[found.first[i] : found.first[i + 1]]
            yield np.unique(gram_hashes(own, max(1, min(words, len(own)))))


def wide_fingerprints(docs: DataFrame, words: int = 5) -> DataFrame:
    """doc_id, tk (hash of the text), fp (binary) of every row, from the set of its shingles."""

    def rows(batches):
        for batch in batches:
            yield batch[["doc_id", "tk"]].assign(fp=[wide_fingerprint(s) for s in _shingles(batch["text"], words)])

    return null_ids(with_ids(docs, "doc_id", F.xxhash64("text").alias("tk"), "text").mapInPandas(rows, "doc_id long, tk long, fp binary"), "doc_id")


def _wide_buckets(batches) -> Iterator:
    import pandas as pd

    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.iloc[at : at + 2000]
            blocks = np.frombuffer(b"".join(part["fp"]), np.uint8).reshape(-1, BLOCK_COUNT, BLOCK_BYTES).astype(np.int64)
            key = (np.arange(BLOCK_COUNT) << 24) | (blocks[:, :, 0] << 16) | (blocks[:, :, 1] << 8) | blocks[:, :, 2]
            spare = blocks[:, :SKETCH_BLOCKS, 2] & ((1 << SPARE_BITS) - 1)
            sketch = (spare << (SPARE_BITS * np.arange(SKETCH_BLOCKS))).sum(axis=1)
            yield pd.DataFrame({"bucket": (key >> SPARE_BITS).ravel(), "id": np.repeat(part["id"].to_numpy(), BLOCK_COUNT), "sketch": np.repeat(sketch, BLOCK_COUNT)})


def _connected(ids: np.ndarray, near) -> Iterator[tuple[np.ndarray, int]]:
    """(members, a linked member), breadth first; ``near(x, rest)`` tells which of the places ``rest`` link to place x."""
    rest = np.arange(len(ids))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            hit = near(x, rest)
            if hit.any():
                yield rest[hit], x
                queue.extend(rest[hit])
                rest = rest[~hit]


def _wide_groups(bits: int):
    """(g, id): the parts of every bucket that hold together within ``bits``; equal parts of several buckets have one g."""
    keys = ["bucket", "lo", "hi"]

    def made(frame):
        import pandas as pd

        g, member = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for _, x in frame.groupby(keys, sort=False):
            if len(x) > 1:
                ids, fps = x["id"].to_numpy(), np.frombuffer(b"".join(x["fp"]), np.uint64).reshape(len(x), -1)
                part = np.arange(len(ids))
                for members, other in _connected(ids, lambda k, rest: np.bitwise_count(fps[rest] ^ fps[k]).sum(axis=1) <= bits):  # noqa: B023
                    part[members] = part[other]
                for k in np.flatnonzero(np.bincount(part) > 1):
                    own = np.sort(ids[part == k])
                    g.append(np.full(len(own), np.uint64(xxhash.xxh64_intdigest(own.tobytes())).view(np.int64)))
                    member.append(own)
        return pd.DataFrame({"g": np.concatenate(g), "id": np.concatenate(member)}).drop_duplicates()

    return _by_key(keys, made)


def _shingle_sets(words: int):
    """id and the set of shingles, as 32-bit hashes."""

    def rows(batches) -> Iterator:
        for batch in batches:
            yield batch[["id"]].assign(shingles=[np.unique(s.astype(np.uint32)).tobytes() for s in _shingles(batch["text"], words)])

    return rows


def _alike(similarity: float):
    """For batches sorted by g: spanning links between the ids whose shingle sets have this Jaccard similarity."""

    def made(frame):
        import pandas as pd

        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for _, x in frame.groupby("g", sort=False):
            ids, sets = x["id"].to_numpy(), [np.frombuffer(s, np.uint32) for s in x["shingles"]]
            size = np.array([len(s) for s in sets])

            def near(k, rest, sets=sets, size=size):
                out = np.zeros(len(rest), bool)
                fit = np.flatnonzero((np.minimum(size[rest], size[k]) >= similarity * np.maximum(size[rest], size[k])) & (size[rest] > 0))
                if len(fit) and size[k]:
                    some = rest[fit]
                    every = np.concatenate([sets[i] for i in some])
                    same = sets[k][np.minimum(np.searchsorted(sets[k], every), size[k] - 1)] == every
                    both = np.add.reduceat(same, np.cumsum(size[some]) - size[some], dtype=np.int64)
                    out[fit] = both >= similarity * (size[some] + size[k] - both) - 1e-9
                return out

            for members, other in _connected(ids, near):
                a.append(ids[members])
                b.append(np.full(len(members), ids[other]))
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

    return _by_key(["g"], made)


def _rooted(docs: DataFrame, words: int, similarity: float, tile: int) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and every distinct one with its root, smallest doc_id and one (did, tk) that stands for it; both stored.

    A fingerprint is named by its own hash, so rows without an id and different texts under one doc_id stay apart.
    """
    prints = stored(wide_fingerprints(docs, words), "simhash-wide")
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), "tk")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min(row).alias("row"), F.min("tk").alias("tk"))
    nodes = stored(nodes.withColumn("id", F.xxhash64("fp")), "simhash-nodes")
    keyed = nodes.select("id", "fp").mapInPandas(_wide_buckets, "bucket long, id long, sketch long")
    # buckets are counted by partial aggregation: those of one row end here, and those of two that differ in too many spare bits
    counts = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_count(F.bit_xor("sketch")).alias("apart"))
    near = (F.col("n") > 2) | ((F.col("n") == 2) & (F.col("apart") <= wide_bits(similarity, SKETCH_BLOCKS * SPARE_BITS)))
    counts = stored(counts.where(near).select("bucket", "n"), "simhash-buckets")
    order = ["bucket", "lo", "hi"]
    met = tiled(keyed.select("bucket", "id").join(counts.hint("merge"), "bucket"), "bucket", "id", tile)
    met = met.join(nodes.select("id", "fp").hint("merge"), "id").repartition(*[F.col(c) for c in order]).sortWithinPartitions(*order).select(*order, "id", "fp")
    groups = stored(met.mapInPandas(_wide_groups(wide_bits(similarity)), "g long, id long").distinct(), "simhash-groups")
    members = stored(groups.select("id").distinct(), "simhash-members")
    wanted = stored(nodes.select("id", "tk").join(members.hint("merge"), "id", "left_semi"), "simhash-wanted")
    texts = join_small(docs.select(F.xxhash64("text").alias("tk"), "text"), wanted, "tk", "inner").select("id", "text").dropDuplicates(["id"])
    sets = stored(texts.mapInPandas(_shingle_sets(words), "id long, shingles binary"), "simhash-sets")
    pairs = groups.join(sets.hint("merge"), "id").repartition("g").sortWithinPartitions("g").select("g", "id", "shingles")
    links = stored(pairs.mapInPandas(_alike(similarity), "a long, b long").distinct(), "simhash-links")
    roots = components(links)
    rooted = nodes.join(roots.hint("merge"), nodes["id"] == roots["u"], "left").select("fp", "least", "row", F.coalesce("root", "id").alias("root"))
    rooted = stored(rooted, "simhash-rooted")
    for done in (nodes, counts, groups, members, wanted, sets, links, roots):
        discard(done)
    return prints, rooted


def similar_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, tile: int = 1024) -> DataFrame:
    """doc_id, component_id of every row: groups of texts whose shingle sets have this similarity, proposed by wide SimHash.

    64 bits tell 0.8 from 0.5 poorly, so the fingerprint has 3072. Texts that agree in 22 bits of one of 128 blocks are compared
    by Hamming distance with a bound of four deviations, and what that leaves by their sets of shingles, which decides. A pair at
    0.8 agrees in some block with probability 0.97. Equal fingerprints meet once; tiles are treated as in ``near_duplicates``.
    Texts without a word (null, empty, blank) are one group. Rows with a null doc_id belong to their group but never name it; groups without any
    doc_id are named by null. Texts under ``words`` words are one shingle; repeated rows get equal answers; an empty table gives no rows.
    """
    prints, rooted = _rooted(docs, words, similarity, tile)
    named = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-names")
    by_print = stored(rooted.join(named.hint("merge"), "root").select("fp", "component_id"), "simhash-named")
    discard(rooted)
    discard(named)
    return prints.join(by_print.hint("merge"), "fp").select("doc_id", "component_id")


def one_of_each_group(docs: DataFrame, words: int = 5, similarity: float = 0.8, tile: int = 1024) -> DataFrame:
    """One row of every group of near copies as ``similar_groups`` finds them, with the columns of ``docs``.

    The row of smallest doc_id stays, null only if the group has no other; of rows equal in doc_id and text any one. Groups are told apart
    by text, so unlike texts without an id, or under one, all stay.
    """
    prints, rooted = _rooted(docs, words, similarity, tile)
    stays = rooted.groupBy("root").agg(F.min("row").alias("row")).select(F.col("row.did").alias("_did"), F.col("row.tk").alias("_tk"))
    stays = stored(stays, "simhash-stays")
    discard(prints)
    discard(rooted)
    # equal rows meet by partial aggregation, and the rows that stay in the same partitions
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    one = docs.select(F.coalesce(docs["doc_id"], F.lit(NO_ID)).alias("_did"), F.xxhash64(docs["text"]).alias("_tk"), row).groupBy("_did", "_tk").agg(F.first("_row").alias("_row"))
    return one.join(stays.hint("merge"), ["_did", "_tk"], "left_semi").select("_row.*")


def query(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
