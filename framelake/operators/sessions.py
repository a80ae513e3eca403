"""Motion windows, coverage and failure streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranges


def _islands(spans: DataFrame, keys: list[str], gap: float) -> DataFrame:
    """Merges spans (start, end, peak_motion, buckets) whose start lies within ``gap`` of the latest end before."""
    order = Window.partitionBy(*keys).orderBy("start")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = spans.withColumn("_new", F.when(F.col("start") - before > gap, 1).otherwise(0))
    numbered = numbered.withColumn("_w", F.sum("_new").over(order.rangeBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_w").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("peak_motion").alias("peak_motion"), F.sum("buckets").alias("buckets")).drop("_w")


def motion_windows(motion: DataFrame, threshold: float, gap: float | None = 60.0, chunk: float = 86400.0) -> DataFrame:
    """Windows of motion per camera: buckets at or above the threshold, merged while the next starts within ``gap``
    of the last one's end (a bucket lasts a second). Returns camera, start, end, peak_motion, buckets.

    Buckets are merged within chunks of time first, so a camera with most of the rows is spread over its days; only the
    chunks' windows meet by camera.
    """
    gap = gap or 60.0
    start = F.col("start_time").cast("double")
    loud = motion.where((F.col("motion") >= threshold) & F.col("start_time").isNotNull())
    spans = loud.select("camera", F.floor(start / chunk).alias("_chunk"), start.alias("start"), (start + 1.0).alias("end"), F.col("motion").alias("peak_motion"), F.lit(1).cast("long").alias("buckets"))
    return _islands(_islands(spans, ["camera", "_chunk"], gap).drop("_chunk"), ["camera"], gap)


def mark_covered(windows: DataFrame, samples: DataFrame, chunk: float = 86400.0) -> DataFrame:
    """Adds covered: a sample of the camera lies in [start, end].

    A sweep: windows (at their start) and samples are one sequence per camera, and a window is covered if the next sample at or after its start comes
    no later than its end. Sequences are cut into chunks of time; of every chunk the first sample is handed to those before. A window is one row, however long.
    """
    points = samples.where("ts is not null").select("camera", F.col("ts").cast("double").alias("_sample")).distinct()
    own = windows.withColumns({"_sample": F.lit(None).cast("double"), "_at": F.col("start").cast("double")})
    met = own.unionByName(points.withColumn("_at", F.col("_sample")), allowMissingColumns=True).withColumn("_chunk", F.floor(F.col("_at") / chunk))
    later = Window.partitionBy("camera", "_chunk").orderBy("_at").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    met = met.withColumn("_next", F.min("_sample").over(later))
    edges = met.groupBy(F.col("camera").alias("_c"), F.col("_chunk").alias("_k")).agg(F.min("_sample").alias("_first"))
    following = Window.partitionBy("_c").orderBy("_k").rowsBetween(1, Window.unboundedFollowing)
    edges = edges.withColumn("_edge", F.min("_first").over(following))
    out = met.where("_sample is null").join(edges.hint("merge"), (F.col("camera") == F.col("_c")) & (F.col("_chunk") == F.col("_k")), "left")
    return out.select(*windows.columns, F.coalesce(F.coalesce("_next", "_edge") <= F.col("end"), F.lit(False)).alias("covered")).withColumn("covered", F.col("covered") & F.col("camera").isNotNull())


def uncovered(windows: DataFrame) -> DataFrame:
    return windows.where(~F.col("covered"))


def newest_windows(windows: DataFrame, k: int, camera: str | None = None) -> DataFrame:
    own = windows.where(F.col("camera") == camera) if camera else windows
    return own.orderBy(F.desc("start"), "camera").limit(k)


def store_windows(stored: DataFrame, found: DataFrame) -> DataFrame:
    """Rows to append: new by (camera, start) against the store and within the batch, with a note on coverage."""
    note = F.when(F.col("covered"), "covered by samples").otherwise("no samples in window")
    first = Window.partitionBy("camera", "start").orderBy(F.desc("end"))
    fresh = found.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return fresh.join(stored.select("camera", "start"), ["camera", "start"], "left_anti").withColumn("notes", note)


def until_failure_streak(responses: DataFrame, run: str, order: list[str], failed: str, streak: int, chunk: Column | None = None) -> DataFrame:
    """Rows of each run up to and with its ``streak``-th failure in a row; later ones are left untouched.

    ``chunk`` is an expression that never falls along ``order`` (a part of the time, say), by default equi-depth ranges of it. Streaks are counted
    within its values, so a run with most of the rows is spread over its chunks; only the chunks' totals meet by run, with the streak that each one inherits.
    """
    placed = ranges.cut(responses, [run], [F.asc(c) for c in order]) if chunk is None else responses
    out = placed.withColumns({"_bad": F.coalesce(F.col(failed).cast("int"), F.lit(0)), "_chunk": F.col("_part") if chunk is None else chunk})
    own = Window.partitionBy(run, "_chunk").orderBy(*order)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({"_n": F.row_number().over(own), "_g": F.sum(1 - F.col("_bad")).over(upto)})
    out = out.withColumn("_s", F.sum("_bad").over(Window.partitionBy(run, "_chunk", "_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    # of every chunk: its rows, failures before the first success, failures after the last one, and where a streak of its own ends
    sums = out.groupBy(run, "_chunk").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_g") == 0).alias("lead"), F.max(F.struct("_n", F.when(F.col("_bad") == 1, F.col("_s")).otherwise(0).alias("s")))["s"].alias("tail"),
        F.min(F.when((F.col("_s") >= streak) & (F.col("_bad") == 1), F.col("_n"))).alias("stop"),
    )
    # a chunk of failures only passes its streak on
    chunks = Window.partitionBy(run).orderBy("_chunk")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("block", F.coalesce(F.sum((F.col("lead") < F.col("rows")).cast("int")).over(before), F.lit(0)))
    last = F.coalesce(F.max(F.when(F.col("lead") < F.col("rows"), F.struct("_chunk", "tail"))).over(before)["tail"], F.lit(0))
    full = F.coalesce(F.sum("lead").over(Window.partitionBy(run, "block").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("carried", last + full)
    early = F.when((F.col("carried") > 0) & (F.col("carried") + F.col("lead") >= streak), streak - F.col("carried"))
    sums = sums.withColumn("stop", F.least(early, F.col("stop")))
    first = F.min(F.when(F.col("stop").isNotNull(), F.struct("_chunk", "stop"))).over(Window.partitionBy(run))
    sums = sums.withColumn("_end", first).select(run, "_chunk", "_end")
    kept = F.col("_end").isNull() | (F.col("_chunk") < F.col("_end._chunk")) | ((F.col("_chunk") == F.col("_end._chunk")) & (F.col("_n") <= F.col("_end.stop")))
    return out.join(sums.hint("merge"), [run, "_chunk"]).where(kept).select(*responses.columns)
