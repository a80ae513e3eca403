"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .io import discard, stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (u, v): every node's neighbours are tied to the smallest of them and the node.

    The minima are written before they are joined: then both sides of the join come straight from a shuffle, and adaptive
    execution can split a node with very many edges.
    """
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
    tied = both.join(least.hint("merge"), "u")
    if large:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
    out = stored(out, "edges")
    discard(least)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node with an edge but the roots, as a stored table; root is the smallest node of the component.

    ``edges`` has two columns of one integer type. The number of rounds is logarithmic; each one's edges are
    written to the shared folder, so lineage stays short, and the last round's are deleted once the next are there.
    """
    u, v = edges.columns
    now = stored(edges.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges")
    seen = None
    while True:
        sign = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(sign) == seen or not sign[0]:
            out = now.select("u", F.col("v").alias("root"))
            out.stored_path = now.stored_path
            return out
        seen = tuple(sign)
        wider = _stars(now, large=True)
        after = _stars(wider, large=False)
        discard(wider)
        discard(now)
        now = after
