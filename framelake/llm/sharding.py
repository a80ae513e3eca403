"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .io import discard, stored, table

#: Places on the ring. The counts per place are all that reaches the driver, whatever the input.
PLACES = 1 << 16
#: Equal rows that one task writes out; more are spread.
COPIES_AT_ONCE = 1 << 16


def ring(shards: int, virtual_nodes: int) -> np.ndarray:
    """For every place the shards in the order in which they are met clockwise: (PLACES, shards)."""
    nodes = sorted((xxhash.xxh64_intdigest(f"{s}/{v}") >> 48, s) for s in range(shards) for v in range(virtual_nodes))
    at = np.array([p for p, _ in nodes])
    owner = [s for _, s in nodes]
    orders = [list(dict.fromkeys(owner[i:] + owner[:i])) for i in range(len(nodes))]
    first = np.searchsorted(at, np.arange(PLACES)) % len(nodes)
    return np.array(orders, np.int32)[first]


def allocate(counts: np.ndarray, orders: np.ndarray, capacity: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Pieces (place, shard, first rank, end rank, first slot): keys past a full shard go on clockwise."""
    room, used, pieces = capacity.astype(np.int64).copy(), np.zeros(len(capacity), np.int64), []
    for place in np.flatnonzero(counts):
        rank, n = 0, int(counts[place])
        for shard in orders[place]:
            fits = int(min(n - rank, room[shard]))
            if fits > 0:
                pieces.append((int(place), int(shard), rank, rank + fits, int(used[shard])))
                room[shard] -= fits
                used[shard] += fits
                rank += fits
            if rank == n:
                break
    return pieces


def shard_documents(docs: DataFrame, shards: int = 8, virtual_nodes: int = 64, headroom: float = 0.0) -> DataFrame:
    """Places every document on the ring by a hash of doc_id, and in the next shard clockwise that has room.

    A shard takes at most (1 + headroom) times its share of the rows; with no headroom the row counts of any two
    shards differ by at most one. Returns doc_id, size (UTF-8 bytes + 1), text_crc32, shard, slot (from 0 without gaps
    in every shard). Null text counts as empty; null doc_id has a place like any other; repeated rows are placed one
    by one; other columns are left out; an empty table gives no rows.

    Ranks within a place are sums over its cells (digits of the text's checksum) and within the cell, and equal rows are one
    row with a count, so that no doc_id, however frequent, is one task's work.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    thin = docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.xxhash64("doc_id").alias("point"))
    kinds = thin.groupBy("doc_id", "size", "text_crc32", "point").agg(F.count(F.lit(1)).alias("n"))
    kinds = stored(kinds.withColumns({"place": F.shiftrightunsigned("point", 48).cast("int"), "cell": F.shiftright("text_crc32", 24).cast("int")}), "shard-keys")
    counts = np.zeros(PLACES, np.int64)
    for row in kinds.groupBy("place").agg(F.sum("n").alias("n")).collect():  # at most PLACES rows
        counts[row["place"]] = row["n"]
    total = int(counts.sum())
    capacity = np.full(shards, total // shards, np.int64)
    capacity[: total % shards] += 1
    if headroom > 0:
        capacity[:] = math.ceil((1 + headroom) * total / shards)
    pieces = allocate(counts, ring(shards, virtual_nodes), capacity)
    plan = kinds.sparkSession.createDataFrame(pieces, "place int, shard int, first long, end long, base long")
    before = Window.partitionBy("place").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = kinds.groupBy("place", "cell").agg(F.sum("n").alias("c")).select("place", "cell", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"))
    cells = stored(cells, "shard-cells")
    within = Window.partitionBy("place", "cell").orderBy("point", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = kinds.withColumn("r0", F.coalesce(F.sum("n").over(within), F.lit(0))).join(cells.hint("merge"), ["place", "cell"]).withColumn("rank", F.col("r0") + F.col("c0"))
    # the plan has at most PLACES + PLACES * shards rows of 32 bytes, by construction
    met = (ranked["place"] == plan["place"]) & (F.col("rank") < F.col("end")) & (F.col("rank") + F.col("n") > F.col("first"))
    lo, hi = F.greatest("rank", "first"), F.least(F.col("rank") + F.col("n"), F.col("end"))
    placed = ranked.join(F.broadcast(plan), met).select("doc_id", "size", "text_crc32", "shard", (F.col("base") + lo - F.col("first")).alias("slot"), (hi - lo).alias("n"))
    placed = stored(placed, "shard-places")
    discard(kinds)
    discard(cells)

    def each(rows: DataFrame) -> DataFrame:
        more = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
        return rows.withColumn("k", more).select("doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("k")).alias("slot"))

    many = placed.where(F.col("n") > COPIES_AT_ONCE).withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES_AT_ONCE).cast("long"))))
    many = many.withColumns({"slot": F.col("slot") + F.col("at"), "n": F.least(F.lit(COPIES_AT_ONCE).cast("long"), F.col("n") - F.col("at"))}).repartition("doc_id", "at")
    return each(placed.where(F.col("n") <= COPIES_AT_ONCE)).union(each(many))


def query(spark, sf_dir):
    return by_rows(table(spark, sf_dir, "documents"))


def by_rows(docs: DataFrame) -> DataFrame:
    """Eight shards under the law ``rows``: doc_id, size, text_crc32, law, shard, slot, grown_shard (null). Nulls, repeats and empty tables
    as in ``shard_documents``."""
    out = shard_documents(docs)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
