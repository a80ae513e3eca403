"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .io import discard, stored

#: Words are runs of characters other than space and U+0009 to U+000D.
WORDS = r"[^\x20\x09-\x0D]+"
#: Parts of one source's shuffled queue; each part is ordered in a task of its own.
CELLS = 4096
#: Parts into which the common queue is divided to find its cut.
STEPS = 1024
#: Entries that one task puts in order; while the cut's part has more, it is divided again.
SORTED_AT_ONCE = 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def fair_targets(totals: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """Target words of every source: shares by weight, none above ``repeats`` times its size.

    ``totals`` has one row per source (skey, source_size). A source is full if its limit lies below its share
    of what the fuller ones leave; sorted by limit / weight the full ones are a prefix. The two windows run over
    one row per source, not over documents. ``level`` is the virtual time at which the budget is spent.
    """
    number = F.row_number().over(Window.orderBy("skey")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (number % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    by_limit = Window.orderBy(F.col("cap") / F.col("weight"), "skey")
    out = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * repeats)
    out = (
        out.withColumn("budget", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("left", F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("own_level", (F.col("budget") - F.col("before")) / F.col("left"))
    )
    level = F.min(F.when(F.col("cap") / F.col("weight") > F.col("own_level"), F.col("before"))).over(every)
    out = out.withColumn("level", F.min(F.when(F.col("before") == level, F.col("own_level"))).over(every))
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level"))
    return out.withColumn("target", F.coalesce(target, F.col("cap").cast("double"))).select(
        "skey", "source_size", "weight", "budget", "level", "target"
    )


def _skey(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _turn(doc_id: Column, seed: int) -> Column:
    """A document's place in its source's shuffled order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null"))))


ORDER = ["finish", "skey", "epoch", "turn", "size"]


def _cut(entries: DataFrame, budget: float, steps: int = STEPS, at_once: int = SORTED_AT_ONCE) -> Callable[[Column, Column], Column]:
    """Which entries (ORDER, words) are taken, in order of ORDER as long as the words fit the budget: a condition on finish and epoch.

    The range of finish times is divided into ``steps`` parts of known words, and the part that holds the cut again, until
    one task can put what is left in order. Each round reads the entries once; there are log(entries) to the base ``steps``.
    """
    base, inside = 0, entries
    while True:
        s = inside.agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words"), F.min("finish").alias("lo"), F.max("finish").alias("hi")).first()
        if base + (s["words"] or 0) <= budget:
            return lambda finish, epoch: F.lit(True)
        if s["n"] <= at_once or s["lo"] == s["hi"]:
            queue = inside.withColumn("upto", F.sum("words").over(Window.partitionBy(F.lit(0)).orderBy(*ORDER)) + base)  # at most at_once rows
            last = queue.where(F.col("upto") <= budget).orderBy(*[F.desc(c) for c in ORDER]).first()
            if last is None:
                return lambda finish, epoch: finish < s["lo"]
            end = F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["skey"]).alias("skey"), F.lit(last["epoch"]).alias("epoch"), F.lit(last["turn"]).alias("turn"), F.lit(last["size"]).cast("long").alias("size"))
            return lambda finish, epoch: F.struct(finish.alias("finish"), F.col("skey"), epoch.alias("epoch"), F.col("turn"), F.col("size")) <= end
        step = F.least(F.floor((F.col("finish") - s["lo"]) * (steps / (s["hi"] - s["lo"]))), F.lit(steps - 1))
        for row in inside.groupBy(step.alias("step")).agg(F.sum("words").alias("words")).orderBy("step").collect():  # at most ``steps`` rows
            if base + row["words"] > budget:
                inside = inside.where(step == row["step"])
                break
            base += row["words"]


def _planned(thin: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """(skey, turn, size, source_size, target, finish, times), stored: one row per place in a source's queue."""
    # rows with equal keys share a place: partial aggregation brings them together
    kinds = thin.groupBy("skey", "turn", "size").agg((F.count(F.lit(1)) * F.col("size")).alias("words"))
    kinds = stored(kinds.withColumn("cell", F.conv(F.substring("turn", 1, 3), 16, 10).cast("int") % CELLS), "mix-kinds")
    sums = kinds.groupBy("skey", "cell").agg(F.sum("words").alias("cell_size"))
    targets = fair_targets(sums.groupBy("skey").agg(F.sum("cell_size").alias("source_size")), weights, share, repeats)
    earlier = Window.partitionBy("skey").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)))
    offsets = stored(offsets.join(targets.hint("merge"), "skey").drop("cell_size"), "mix-cells")
    # a source of any size is spread over its cells
    within = Window.partitionBy("skey", "cell").orderBy("turn", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = kinds.withColumn("within", F.sum("words").over(within)).join(offsets.hint("merge"), ["skey", "cell"])
    queued = stored(queued.withColumn("place", F.col("offset") + F.col("within")).drop("offset", "within", "cell"), "mix-queue")
    discard(kinds)
    discard(offsets)

    def finish(epoch: int) -> Column:
        return (F.col("place") + F.col("source_size") * epoch) / F.col("weight")

    entries = F.array(*[F.struct(finish(e).alias("finish"), "skey", F.lit(e).alias("epoch"), "turn", "size", "words") for e in range(repeats)])
    first = queued.select("budget").first()
    taken = _cut(queued.where("size > 0").select(F.inline(entries)), first["budget"] if first else 0)
    hits = sum((taken(finish(e), F.lit(e)).cast("int") for e in range(1, repeats)), taken(finish(0), F.lit(0)).cast("int"))
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(hits).cast("int")
    plan = stored(queued.select("skey", "turn", "size", "source_size", "target", finish(0).alias("finish"), times.alias("times")), "mix-plan")
    discard(queued)
    return plan


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 17,
    text: str = "text",
) -> DataFrame:
    """How often the mix takes each document.

    Every source queues its documents in a fixed shuffled order (digest of seed and doc_id), ``repeats`` times over.
    An entry's virtual finish time is the source's words up to and including it, divided by the source's weight.
    All entries are ordered by finish time and taken while their words fit ``share`` times all words.

    Returns one row per document: doc_id, source, size, source_size, target, finish, times, taken.
    Null text has size 0; null source is a source of its own, last. Documents of size 0 take no words. Rows with the
    same doc_id, source and size share one place in the queue and one decision. An empty table gives no rows.
    """
    thin = docs.select("doc_id", "source", _skey(F.col("source")).alias("skey"), _turn(F.col("doc_id"), seed).alias("turn"), word_count(F.col(text)).alias("size"))
    thin = stored(thin, "mix-sizes")
    out = thin.join(_planned(thin, weights, share, repeats).hint("merge"), ["skey", "turn", "size"])
    return out.select("doc_id", "source", "size", "source_size", "target", "finish", "times", (F.col("size") * F.col("times")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2, seed: int = 17, text: str = "text") -> DataFrame:
    """The documents that the mix takes, each as often as it is taken, with the columns of ``docs``; nulls, repeats and empties as in ``mix_sources``."""
    keys = [_skey(docs["source"]).alias("skey"), _turn(docs["doc_id"], seed).alias("turn"), word_count(docs[text]).alias("size")]
    plan = _planned(docs.select(*keys), weights, share, repeats).where("times > 0").select("skey", "turn", "size", "times")
    rows = docs.select(*keys, F.struct(*[docs[c] for c in docs.columns]).alias("row")).join(plan.hint("merge"), ["skey", "turn", "size"])
    return rows.select(F.explode(F.array_repeat("row", F.col("times"))).alias("row")).select("row.*")


def query(spark, sf_dir):
    from .io import table

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH thin AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, 'null')) AS turn
  FROM documents),
totals AS (SELECT skey, sum(size)::BIGINT AS source_size FROM thin GROUP BY skey),
weighted AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY skey) - 1) % 3 + 1] AS weight, source_size * 2 AS cap FROM totals),
filled AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5 AS budget,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before,
         (sum(weight) OVER (ORDER BY cap / weight, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rest
  FROM weighted),
levels AS (SELECT *, (budget - before) / rest AS own_level FROM filled),
level AS (SELECT own_level AS level FROM levels WHERE cap / weight > own_level ORDER BY before LIMIT 1),
targets AS (
  SELECT skey, source_size, weight, budget,
         coalesce(least(cap::DOUBLE, weight * (SELECT level FROM level)), cap::DOUBLE) AS target
  FROM levels),
queued AS (
  SELECT t.*, s.source_size, s.weight, s.budget, s.target, e.epoch,
         (sum(size) OVER (PARTITION BY t.skey, e.epoch ORDER BY turn, size) + e.epoch * s.source_size)::DOUBLE / s.weight AS finish
  FROM thin t JOIN targets s USING (skey), (SELECT unnest([0, 1]) AS epoch) e),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, skey, epoch, turn, size) AS upto FROM queued)
SELECT doc_id, size, max(source_size) AS source_size, max(target) AS target,
       sum(CASE WHEN upto <= budget THEN size ELSE 0 END)::BIGINT AS taken
FROM placed GROUP BY doc_id, skey, size
"""
