"""Which rows are dominated on three measures: ranges of one sort order, each swept against the staircases of those before."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lineage import discard, written


def finite_or_last(latency: str) -> Column:
    """A latency of null or 0 was not measured: it counts as infinite."""
    known = F.coalesce(latency, F.lit(0.0))
    return F.when(known == 0, F.lit(float("inf"))).otherwise(known)


class BestNames:
    """The two smallest latencies of different names for every prefix of a fixed order of recalls, highest first."""

    def __init__(self, recalls: np.ndarray):
        self.order = np.unique(-recalls).tolist()
        self.tree: list[tuple] = [()] * (len(self.order) + 1)

    def add(self, recall: float, latency: float, name: str) -> None:
        i = bisect_left(self.order, -recall) + 1
        while i < len(self.tree):
            now = self.tree[i]
            if not now:
                self.tree[i] = ((latency, name),)
            elif len(now) < 2 or latency < now[1][0] or (name == now[0][1] and latency < now[0][0]):
                best = [x for x in now if x[1] != name or x[0] <= latency]
                if not any(x[1] == name for x in best):
                    best.append((latency, name))
                self.tree[i] = tuple(sorted(best)[:2])
            i += i & -i

    def within(self, recall: float, latency: float) -> list[str]:
        """Up to two different names with at least this recall and at most this latency."""
        found: list[str] = []
        i = bisect_left(self.order, -recall) + 1
        while i:
            for known, name in self.tree[i]:
                if known <= latency and name not in found:
                    found.append(name)
            if len(found) >= 2:
                break
            i -= i & -i
        return found[:2]


def staircase(frame):
    """Points (r, l, name) that fewer than two names reach at no less recall and no more latency; others add nothing for later rows."""
    flat = frame.melt(id_vars=["r", "l"], value_vars=["low", "high"], value_name="name").drop_duplicates(["r", "l", "name"])
    flat = flat.sort_values(["r", "l"], ascending=[False, True], kind="stable")
    best: list[tuple[float, str]] = []
    stay = []
    for latency, name in zip(flat["l"].tolist(), flat["name"].tolist()):
        others = [x for x in best if x[1] != name]
        own = min((x[0] for x in best if x[1] == name), default=np.inf)
        keep = own > latency and sum(x[0] <= latency for x in others) < 2 if best else True
        stay.append(keep)
        if keep:
            best = sorted([*others, (latency, name)])[:2]
    return flat.loc[np.array(stay, bool), ["r", "l", "name"]] if len(flat) else flat[["r", "l", "name"]]


def _whole(batches, key: str) -> Iterator:
    """Frames with all rows of a key, for batches sorted by it."""
    import pandas as pd

    held: list = []
    for batch in batches:
        for value, part in batch.groupby(key, sort=False):
            if held and held[0][key].iat[0] != value:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True)


def _stairs(batches) -> Iterator:
    for frame in _whole(batches, "_part"):
        yield staircase(frame).assign(_part=frame["_part"].iat[0])


def _swept(batches) -> Iterator:
    """For rows sorted by part, kind and order: kind 0 are points of earlier parts; for those of kind 1 up to two names that dominate them."""
    import pandas as pd

    for frame in _whole(batches, "_part"):
        best = BestNames(frame["r"].to_numpy())
        out = []
        for kind, m, r, latency, low, high in zip(*[frame[c].tolist() for c in ("kind", "m", "r", "l", "low", "high")]):
            if kind:
                names = best.within(r, latency)
                if names:
                    out.append((m, r, latency, min(names), max(names)))
            # every dominator of a row stands before it in the order, and equal rows are one
            best.add(r, latency, low)
            if high != low:
                best.add(r, latency, high)
        yield pd.DataFrame(out, columns=["m", "r", "l", "low", "high"])


def dominated(rows: DataFrame) -> DataFrame:
    """(m, r, l, low, high) of the dominated measures among ``rows`` (name, m, r, l): those with no worse m (high), r (high) and l (low), and a
    better one, at some other row. ``low`` and ``high`` are names that dominate them: equal if it is only one, so a row of that name is not dominated.

    Equal measures are one row with its smallest and largest name. In the order of m, r (descending) and l every dominator comes before what it
    dominates, so ranges of that order are swept by themselves, after the points of earlier ranges that matter: the staircase of recall against
    latency, by two names. Null and NaN measures compare with nothing.
    """
    known = rows.where(F.col("name").isNotNull() & F.col("m").isNotNull() & F.col("r").isNotNull() & ~F.isnan("m") & ~F.isnan("r") & ~F.isnan("l"))
    kinds = known.groupBy("m", "r", "l").agg(F.min("name").alias("low"), F.max("name").alias("high"))
    order = [F.desc("m"), F.desc("r"), F.asc("l")]
    cut = written(kinds.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    last = cut.agg(F.max("_part")).first()[0] or 0
    points = cut.repartition("_part").sortWithinPartitions("_part").mapInPandas(_stairs, "r double, l double, name string, _part int")
    later = points.where(F.col("_part") < last).withColumn("_part", F.explode(F.sequence(F.col("_part") + 1, F.lit(last))))
    sent = later.select("_part", F.lit(0).alias("kind"), F.lit(None).cast("double").alias("m"), "r", "l", F.col("name").alias("low"), F.col("name").alias("high"))
    met = sent.union(cut.select("_part", F.lit(1).alias("kind"), "m", "r", "l", "low", "high"))
    met = met.repartition("_part").sortWithinPartitions("_part", "kind", *order)
    out = written(met.mapInPandas(_swept, "m double, r double, l double, low string, high string"))
    discard(cut)
    return out
