"""Detection metrics: greedy matching, average precision, Pareto frontier and the acceptance gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import boxes
from ..lineage import discard, written
from . import matching, ranges, skyline

THRESHOLDS = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))
SMALL_AREA = 0.0025


def match(predictions: DataFrame, truths: DataFrame, thresholds=THRESHOLDS, keys=("candidate",), scope: str = "image_id") -> DataFrame:
    """Greedy matching per class and threshold: predictions by confidence, each takes the free truth with the highest IoU
    strictly above the threshold; ties go to the smaller truth_id.

    ``scope`` keeps boxes of different images apart (``matching.within``); "pooled" lets them match across images (``matching.pooled``). Returns keys, scope
    unless pooled, label, threshold, prediction_id, confidence, truth_id.
    """
    return matching.pooled(predictions, truths, thresholds, keys) if scope == "pooled" else matching.within(predictions, truths, thresholds, keys, scope)


def average_precision(matches: DataFrame, truths: DataFrame, keys=("candidate",), recall_base: str = "matched", thresholds=None) -> DataFrame:
    """101-point interpolated AP per key, class and threshold. ``matches`` is read twice: write it first (``lineage.written``).

    ``recall_base``: "matched" divides recall by the matched predictions, "truths" by all truths. Classes with truths and no
    match get 0; classes without truths have no row. ``thresholds`` names those of the matches, else they are looked up.
    """
    group = [*keys, "label", "threshold"]
    hit = F.col("truth_id").isNotNull().cast("long")
    # running counts in two steps: within equi-depth ranges of (class, confidence), and over the class's ranges before. Precision at a number of true
    # positives is best at the hit that reaches it, so only hits go on
    order = [F.desc("confidence"), F.asc("prediction_id")]
    own = matches.select(*group, "confidence", "prediction_id", hit.alias("hit")).repartitionByRange(*[F.col(c).asc() for c in group], *order)
    own = own.sortWithinPartitions(*group, *order).select(*group, "hit", F.spark_partition_id().alias("_part"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.drop("hit").schema.fields) + ", tp long, k long, hits long, n long"
    placed = written(own.mapInArrow(_running(group), schema))
    curve = ranges.with_before(placed, group, tp0=F.col("hits"), k0=F.col("n")).where("tp is not null")
    counts = truths.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("n_truths"))
    tops = curve.select(*group, (F.col("tp") + F.col("tp0")).alias("tp"), F.col("tp0_all").alias("all"), ((F.col("tp") + F.col("tp0")) / (F.col("k") + F.col("k0"))).alias("p"))
    if recall_base != "matched":
        tops = tops.join(counts.hint("merge"), [*keys, "label"])
    base = F.col("all") if recall_base == "matched" else F.col("n_truths")
    levels = tops.withColumn("last", F.least(F.lit(100), F.floor(F.col("tp") * 100 / base + 1e-9)).cast("int")).groupBy(*group, "last").agg(F.max("p").alias("p"))
    # the best precision at or after each level: a running maximum over at most 101 rows
    grid = levels.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("last", "p"))).alias("m"))
    best = F.transform(F.sequence(F.lit(0), F.lit(100)), lambda r: F.coalesce(F.array_max(F.map_values(F.map_filter("m", lambda k, v: k >= r))), F.lit(0.0)))
    ap = grid.select(*group, (F.aggregate(best, F.lit(0.0), lambda a, x: a + x) / 101).alias("ap"))
    if thresholds is None:  # one row per threshold
        thresholds = sorted(r[0] for r in matches.select("threshold").distinct().collect())
    every = counts.withColumn("threshold", F.explode(F.array(*[F.lit(float(x)) for x in thresholds]) if thresholds else F.array().cast("array<double>")))
    return every.join(ap.hint("merge"), group, "left").select(*group, "n_truths", F.coalesce("ap", F.lit(0.0)).alias("ap"))


def _running(group: list[str]):
    """For rows sorted by group and order: one row for each hit with its running numbers of hits (tp) and rows (k) in this part of the group, and rows
    without these with the part's totals (hits, n), which add up."""

    def rows(batches):
        import numpy as np
        import pyarrow as pa

        last, tp, k = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            hit, size = batch.column("hit").to_numpy(), batch.num_rows
            new = ranges.changed(batch, group, last)
            starts, own = np.flatnonzero(new), np.cumsum(new)
            tps, ks = np.cumsum(hit), np.arange(1, size + 1)
            tps = tps - np.concatenate([[-tp], (tps - hit)[starts]])[own]
            ks = ks - np.concatenate([[-k], starts])[own]
            hits, firsts = np.flatnonzero(hit), np.flatnonzero(new | (np.arange(size) == 0))
            totals = np.add.reduceat(hit, firsts), np.diff([*firsts, size])
            at = np.concatenate([hits, firsts])
            known = np.concatenate([np.zeros(len(hits), bool), np.ones(len(firsts), bool)])
            none = np.zeros(len(firsts), np.int64)
            columns = [batch.column(c).take(pa.array(at)) for c in (*group, "_part")]
            columns += [pa.array(np.concatenate([x[hits], none]), mask=known) for x in (tps, ks)]
            columns += [pa.array(np.concatenate([np.zeros(len(hits), np.int64), x]).astype(np.int64)) for x in totals]
            yield pa.RecordBatch.from_arrays(columns, names=[*group, "_part", "tp", "k", "hits", "n"])
            last, tp, k = [batch.column(c)[-1].as_py() for c in group], int(tps[-1]), int(ks[-1])

    return rows


def class_metrics(predictions: DataFrame, truths: DataFrame, matches: DataFrame, keys=("candidate",), ap50: DataFrame | None = None) -> DataFrame:
    """Per key and class at IoU 0.5: tp, fp, n_truths, precision, recall, f1 (and ap50). Classes without truths get zeros, their
    predictions count as no false positives."""
    own = matches.where("threshold = 0.5").groupBy(*keys, "label").agg(F.count("truth_id").alias("tp"), F.count(F.lit(1)).alias("n_predictions"))
    counts = truths.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("n_truths"))
    out = own.join(counts.hint("merge"), [*keys, "label"], "full").fillna(0, ["tp", "n_predictions", "n_truths"])
    out = out.withColumns({"tp": F.when(F.col("n_truths") > 0, F.col("tp")).otherwise(0), "fp": F.when(F.col("n_truths") > 0, F.col("n_predictions") - F.col("tp")).otherwise(0)})
    p, r = boxes.ratio(F.col("tp"), F.col("tp") + F.col("fp")), boxes.ratio(F.col("tp"), F.col("n_truths"))
    out = out.withColumns({"precision": p, "recall": r})
    out = out.withColumn("f1", boxes.ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    if ap50 is not None:
        out = out.join(ap50.where("threshold = 0.5").select(*keys, "label", F.col("ap").alias("ap50")).hint("merge"), [*keys, "label"], "left").fillna(0.0, ["ap50"])
    return out.drop("n_predictions")


def small_recall(truths: DataFrame, matches: DataFrame, keys=("candidate",), most: float = SMALL_AREA) -> DataFrame:
    """Share of truths below an area that some prediction takes at IoU 0.5."""
    taken = matches.where("threshold = 0.5 and truth_id is not null").select(*keys, "truth_id").distinct().withColumn("_hit", F.lit(1))
    small = truths.where(boxes.area(boxes.box("x1", "y1", "x2", "y2")) < most)
    joined = small.join(taken.hint("merge"), [*keys, "truth_id"], "left")
    return joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("small_truths"), F.count("_hit").alias("small_found")).withColumn("small_recall", F.col("small_found") / F.col("small_truths"))


def evaluate(predictions: DataFrame, truths: DataFrame, thresholds=THRESHOLDS, keys=("candidate",), scope: str = "image_id", recall_base: str = "matched") -> DataFrame:
    """Overall metrics per key: map50, map50_95 (means over classes with truths), precision, recall, f1, fp_rate, totals."""
    thresholds = tuple(thresholds) if 0.5 in thresholds else (0.5, *thresholds)
    found = written(match(predictions, truths, thresholds, keys, scope))  # read four times below
    ap = average_precision(found, truths, keys, recall_base, thresholds)
    means = ap.groupBy(*keys).agg(F.avg(F.when(F.col("threshold") == 0.5, F.col("ap"))).alias("map50"), F.avg("ap").alias("map50_95"))
    totals = class_metrics(predictions, truths, found, keys).groupBy(*keys).agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("n_truths").alias("n_truths"))
    p, r = boxes.ratio(F.col("tp"), F.col("tp") + F.col("fp")), boxes.ratio(F.col("tp"), F.col("n_truths"))
    out = totals.join(means.hint("merge"), list(keys), "left").fillna(0.0, ["map50", "map50_95"]).withColumns({"precision": p, "recall": r})
    f1 = boxes.ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.withColumns({"f1": f1, "fp_rate": F.when(F.col("tp") + F.col("fp") > 0, 1 - F.col("precision")).otherwise(0.0)}).join(small_recall(truths, found, keys).hint("merge"), list(keys), "left")


def golden_examples(images: DataFrame, boxes_: DataFrame, classes: DataFrame, limit: int | None = None) -> DataFrame:
    """Images with their labelled boxes; an optional number of images in order of id."""
    own = images.orderBy("image_id").limit(limit) if limit is not None else images
    named = boxes_.join(F.broadcast(classes), "class_id")  # a class table
    nested = named.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("label", "x1", "y1", "x2", "y2"))).alias("boxes"))
    return own.join(nested.hint("merge"), "image_id", "left")


def latency_summary(timings: DataFrame, keys=("candidate",)) -> DataFrame:
    """Mean latency and frames per second of the timed calls; warm-ups are left out."""
    out = timings.where(~F.col("warmup")).groupBy(*keys).agg(F.avg("latency_ms").alias("latency_ms"))
    return out.withColumn("fps", F.when(F.col("latency_ms") != 0, 1000 / F.col("latency_ms")))


def benchmark(predictions: DataFrame, truths: DataFrame, timings: DataFrame, **options) -> DataFrame:
    """Metrics and latency of all candidates in one job."""
    return evaluate(predictions, truths, **options).join(latency_summary(timings).hint("merge"), "candidate", "left")


def pareto_frontier(candidates: DataFrame) -> DataFrame:
    """Candidates that no other dominates on map50, recall and latency, by map50, then latency with null as 0.

    Latency null or 0 counts as infinite; rows of the same name do not compare; null measures compare with nothing. See ``skyline``.
    """
    names = skyline.dominated(candidates.select("name", F.col("map50").alias("m"), F.col("recall").alias("r"), skyline.finite_or_last("latency_ms").alias("l")))
    same = (F.col("map50") == names["m"]) & (F.col("recall") == names["r"]) & (skyline.finite_or_last("latency_ms") == names["l"])
    out = candidates.join(names.hint("merge"), same, "left")
    beaten = F.coalesce((F.col("low") != F.col("name")) | (F.col("high") != F.col("name")), F.lit(False))
    return out.where(~beaten).select(*candidates.columns).orderBy(F.desc("map50"), F.coalesce("latency_ms", F.lit(0.0)), "name")


def _measures(frame):
    """(names, map50, recall, latency) of a pandas frame; latency null or 0 counts as infinite."""
    import numpy as np

    slow = frame["latency_ms"].fillna(0.0).to_numpy(float)
    return frame["name"].to_numpy(object), frame["map50"].to_numpy(float), frame["recall"].to_numpy(float), np.where(slow == 0, np.inf, slow)


def _dominators(row, names, m, r, s):
    """Which of these rows dominate ``row`` = (name, map50, recall, latency): no worse in all, better in one, of another name."""
    name, m1, r1, s1 = row
    return (names != name) & (m >= m1) & (r >= r1) & (s <= s1) & ((m > m1) | (r > r1) | (s < s1))


#: Frontier rows that a task compares its candidates with at once.
FRONTIER_BLOCK = 100_000


def dominators(candidates: DataFrame, block: int = FRONTIER_BLOCK) -> DataFrame:
    """Every candidate with the sorted names on the frontier that dominate it: none for the frontier itself.

    (A dominated candidate is dominated from the frontier, or by a row of another name that only its own namesakes dominate.) The
    frontier is sent to the tasks in blocks; candidates are compared where they are read, and no pair table is made.
    """
    front = written(pareto_frontier(candidates).select("name", "map50", "recall", "latency_ms"))
    parts = max(1, -(-front.count() // block))
    out = candidates.withColumn("dominated_by", F.array().cast("array<string>"))
    schema = out.schema
    for part in range(parts):
        own = front.where(F.pmod(F.xxhash64("name"), F.lit(parts)) == part).toPandas()
        sent = candidates.sparkSession.sparkContext.broadcast(_measures(own))

        def rows(batches, sent=sent):
            for batch in batches:
                names, m, r, s = sent.value
                found = [names[_dominators(row, names, m, r, s)] for row in zip(*_measures(batch))]
                yield batch.assign(dominated_by=[sorted({*old, *new}) for old, new in zip(batch["dominated_by"], found)])

        out = out.mapInPandas(rows, schema)
    return out


def benchmark_view(results: DataFrame, baseline: str | None = None, limit: int | None = None) -> DataFrame:
    """Benchmark results by map50 with on_frontier and is_baseline; an optional number of them."""
    front = pareto_frontier(results).select("name").distinct().withColumn("on_frontier", F.lit(True))
    out = results.join(front.hint("merge"), "name", "left").withColumns({"on_frontier": F.coalesce("on_frontier", F.lit(False)), "is_baseline": F.coalesce(F.col("name") == baseline, F.lit(False))})
    out = out.orderBy(F.desc("map50"), "name")
    return out.limit(limit) if limit is not None else out


def with_baseline(candidates: DataFrame, baseline: str) -> DataFrame:
    """Adds the baseline's values; null for the baseline itself and when there is none."""
    base = candidates.where(F.col("name") == baseline).select(F.col("map50").alias("base_map50"), F.col("recall").alias("base_recall"), F.col("fp_rate").alias("base_fp_rate")).limit(1)
    return candidates.join(F.broadcast(base), F.col("name") != baseline, "left")


def gate(candidates: DataFrame, baseline: str, max_latency_ms=20.0, max_cpu=80.0, min_recall_delta=-0.02, min_map50_delta=-0.02, max_fp_delta=0.05) -> DataFrame:
    """Adds passed and the ordered reasons (check, value, bound, passed), one for every check made. Latency that was not measured
    passes with a null value, an unmeasured processor load is not checked, and without a baseline there are no deltas."""
    c = with_baseline(candidates, baseline)

    def check(name: str, value: Column, bound: float, ok: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), F.lit(float(bound)).alias("bound"), F.coalesce(ok, F.lit(True)).alias("passed"))

    delta = lambda m: F.col(m) - F.col(f"base_{m}")
    measured = F.col("base_recall").isNotNull()
    checks = F.array(
        check("latency_ms", F.col("latency_ms"), max_latency_ms, F.col("latency_ms") <= max_latency_ms),
        F.when(F.col("cpu_percent").isNotNull(), check("cpu_percent", F.col("cpu_percent"), max_cpu, F.col("cpu_percent") <= max_cpu)),
        F.when(measured, check("recall_delta", delta("recall"), min_recall_delta, delta("recall") >= min_recall_delta)),
        F.when(measured, check("map50_delta", delta("map50"), min_map50_delta, delta("map50") >= min_map50_delta)),
        F.when(measured, check("fp_rate_delta", delta("fp_rate"), max_fp_delta, delta("fp_rate") <= max_fp_delta)),
    )
    out = c.withColumn("reasons", F.array_compact(checks))
    return out.withColumn("passed", F.forall("reasons", lambda x: x["passed"]))


def latest_deployment(ledger: DataFrame, per_model: bool = True) -> DataFrame:
    """The newest row per model, or the newest of all."""
    if not per_model:
        return ledger.orderBy(F.desc("created_at"), F.desc("id")).limit(1)
    w = Window.partitionBy("model_name").orderBy(F.desc("created_at"), F.desc("id"))
    return ledger.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
