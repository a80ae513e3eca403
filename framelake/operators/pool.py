"""Queries on the sample pool: filters, pages, counts and summaries (F, K, A rows of the inventory).

Samples: id, camera, ts (epoch seconds), event_id, image_path, image_hash, status, quality, verified (0/1), feed_label,
created_at. Annotations: id, sample_id, event_id, source, label, x1, y1, x2, y2, confidence, verified, created_at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times

VERDICTS = ("useful", "bad", "duplicate", "ignore")


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def with_label(samples: DataFrame, annotations: DataFrame, labels: list[str]) -> DataFrame:
    """Samples that have an annotation with one of the labels (semi-join)."""
    return samples.join(annotations.where(F.col("label").isin(labels)).select(F.col("sample_id").alias("id")), "id", "left_semi")


def annotation_counts(samples: DataFrame, annotations: DataFrame) -> DataFrame:
    """Adds n_annotations, 0 where there are none."""
    counts = annotations.groupBy(F.col("sample_id").alias("id")).agg(F.count(F.lit(1)).alias("n_annotations"))
    return samples.join(counts, "id", "left").withColumn("n_annotations", F.coalesce("n_annotations", F.lit(0)))


def search(samples: DataFrame, annotations: DataFrame, status=None, quality=None, camera=None, label=None, verified=None) -> DataFrame:
    """Sample search: equality filters, a label semi-join, and the fields of a result item."""
    wanted = {"status": status, "quality": quality, "camera": camera, "verified": None if verified is None else int(verified)}
    out = samples.where(_all([F.col(k) == v for k, v in wanted.items() if v is not None]))
    if label is not None:
        out = with_label(out, annotations, [label])
    return annotation_counts(out, annotations).withColumns(
        {
            "has_annotations": F.col("n_annotations") > 0,
            "has_image": F.col("image_path").isNotNull(),
            "image_url": F.concat(F.lit("/images/"), F.col("id")),
        }
    )


def page(df: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    """A page of the newest rows first, with the total in every row; the limit is kept within 1 to 200."""
    limit, offset = min(max(limit, 1), 200), max(offset, 0)
    rows = df.orderBy(F.desc("ts"), "id").offset(offset).limit(limit)
    total = df.agg(F.count(F.lit(1)).alias("total"))  # one row
    return rows.crossJoin(F.broadcast(total))


def page_after(df: DataFrame, ts: float | None, ident: str | None, limit: int = 50) -> DataFrame:
    """The page that follows a row, without counting off the rows before it."""
    limit = min(max(limit, 1), 200)
    if ts is not None:
        df = df.where((F.col("ts") < ts) | ((F.col("ts") == ts) & (F.col("id") > ident)))
    return df.orderBy(F.desc("ts"), "id").limit(limit)


def sample_view(samples: DataFrame, annotations: DataFrame) -> DataFrame:
    """Every sample with its annotations in order of creation, nested."""
    whole = _all([F.col(c).isNotNull() for c in ("x1", "y1", "x2", "y2")])
    box = F.when(whole, F.struct("x1", "y1", "x2", "y2"))
    item = F.struct("created_at", "id", "source", "label", "confidence", "verified", box.alias("box"))
    nested = annotations.groupBy(F.col("sample_id").alias("_sid")).agg(F.sort_array(F.collect_list(item)).alias("annotations"))
    return samples.join(nested, F.col("id") == F.col("_sid"), "left").drop("_sid").withColumn("annotations", F.coalesce("annotations", F.array().cast(nested.schema["annotations"].dataType)))


def report_records(samples: DataFrame, annotations: DataFrame, cameras=None, since_ts=None, labels=None, quality=None, most: int = 50_000) -> DataFrame:
    """Newest samples of a report."""
    out = samples.where(_all([F.col("camera").isin(cameras)] if cameras else []) & _all([F.col("ts") >= since_ts] if since_ts is not None else []) & _all([F.col("quality") == quality] if quality else []))
    if labels:
        out = with_label(out, annotations, labels)
    return out.orderBy(F.desc("ts"), "id").limit(most)


def report_groups(records: DataFrame) -> DataFrame:
    """Camera, UTC day, the day's frames in time order, and the camera's frames in all."""
    days = records.groupBy("camera", times.day_key(F.col("ts")).alias("day")).agg(F.sort_array(F.collect_list(F.struct("ts", "id"))).alias("_f"))
    return days.select("camera", "day", F.col("_f.id").alias("frames"), F.size("_f").alias("n"), F.sum(F.size("_f")).over(Window.partitionBy("camera")).alias("camera_frames"))


def report_totals(records: DataFrame) -> DataFrame:
    """Frames by camera and day, by camera, and in all."""
    return records.rollup("camera", times.day_key(F.col("ts")).alias("day")).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


def verify_candidates(samples: DataFrame, annotations: DataFrame, force=False, camera=None, labels=None, since_ts=None, limit=None) -> DataFrame:
    """Samples to verify: not bad (unjudged ones count), not yet verified unless forced; oldest first."""
    out = samples.where(F.col("quality").isNull() | (F.col("quality") != "bad"))
    if not force:
        out = out.where("verified = 0")
    out = out.where(_all([F.col("camera") == camera] if camera else []) & _all([F.col("ts") >= since_ts] if since_ts is not None else []))
    if labels:
        out = with_label(out, annotations, labels)
    out = out.orderBy("ts", "id")
    return out.limit(limit) if limit is not None else out


def build_selection(samples: DataFrame, annotations: DataFrame, cameras=None, labels=None, quality=None, since: str | None = None) -> DataFrame:
    """Samples of a dataset build: collected, of one verdict (useful or unjudged by default), created since a text time."""
    judged = F.col("quality") == quality if quality else F.col("quality").isNull() | (F.col("quality") == "useful")
    out = samples.where((F.col("status") == "collected") & judged)
    out = out.where(_all([F.col("camera").isin(cameras)] if cameras else []) & _all([F.col("created_at") >= since] if since else []))
    return with_label(out, annotations, labels) if labels else out


def triage_batch(samples: DataFrame, annotations: DataFrame, cameras=None, labels=None, since_ts=None, limit=None) -> DataFrame:
    """Ids of a triage batch, oldest first."""
    out = samples.where(_all([F.col("camera").isin(cameras)] if cameras else []) & _all([F.col("ts") >= since_ts] if since_ts is not None else []))
    if labels:
        out = with_label(out, annotations, labels)
    out = out.orderBy("ts", "id")
    return (out.limit(limit) if limit is not None else out).select("id")


def usable_boxes(annotations: DataFrame, classes: DataFrame) -> DataFrame:
    """Annotations with a known class and a proper box; the class table is small by nature."""
    proper = _all([F.col(c).isNotNull() for c in ("x1", "y1", "x2", "y2")]) & (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))
    return annotations.where(proper).join(F.broadcast(classes), "label")


def annotated_samples(annotations: DataFrame, samples: DataFrame) -> DataFrame:
    """Annotations with the fields of their samples."""
    own = samples.select(F.col("id").alias("sample_id"), "camera", "ts", "image_path", "status", "quality")
    return annotations.join(own, "sample_id")


def pool_objects(annotations: DataFrame, samples: DataFrame, source: str, width: int, height: int, statuses=None, qualities=None) -> DataFrame:
    """Objects of one source as pixel boxes, or the reason why they are skipped."""
    from ..functions import boxes

    joined = annotated_samples(annotations.where((F.col("source") == source) & (F.length(F.trim("label")) > 0)), samples).where("image_path is not null")
    joined = joined.where(_all([F.col("status").isin(statuses)] if statuses else []) & _all([F.col("quality").isin(qualities)] if qualities else []))
    box, reason = boxes.stored_box(boxes.box("x1", "y1", "x2", "y2"), width, height)
    return joined.withColumns({"box": box, "skip_reason": reason})


def pool_objects_from_samples(samples: DataFrame, width: int, height: int) -> DataFrame:
    """The same from pools without annotations: the box columns of the samples themselves."""
    from ..functions import boxes

    box, reason = boxes.stored_box(boxes.box("x1", "y1", "x2", "y2"), width, height)
    return samples.where("image_path is not null and length(trim(feed_label)) > 0").withColumns({"box": box, "skip_reason": reason})


def quality_counts(samples: DataFrame, annotations: DataFrame) -> DataFrame:
    """One row: totals, a count per verdict, samples with a verified box, verified boxes; problematic = bad + duplicate."""
    counted = samples.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("verified") == 1).alias("verified"),
        F.count_if(F.col("verified") != 1).alias("unverified"),
        *[F.count_if(F.col("quality") == v).alias(v) for v in VERDICTS],
        F.count_if(F.col("quality").isin("bad", "duplicate")).alias("problematic"),
    )
    boxes = annotations.where("verified = 1").agg(F.countDistinct("sample_id").alias("verified_samples"), F.count(F.lit(1)).alias("verified_boxes"))
    return counted.crossJoin(F.broadcast(boxes))  # one row each


def overview(samples: DataFrame, annotations: DataFrame) -> DataFrame:
    """The quality summary with the sorted distinct cameras."""
    cameras = samples.select("camera").where("camera is not null").distinct().agg(F.sort_array(F.collect_list("camera")).alias("cameras"))
    return quality_counts(samples, annotations).crossJoin(F.broadcast(cameras))


def status_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "status")


def pool_statistics(samples: DataFrame, annotations: DataFrame, failures: DataFrame) -> DataFrame:
    """One row of totals: samples, unverified annotations, failures."""
    parts = [samples.agg(F.count(F.lit(1)).alias("samples")), annotations.agg(F.count_if(F.col("verified") == 0).alias("unverified_annotations")), failures.agg(F.count(F.lit(1)).alias("failures"))]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each


def top_cameras(samples: DataFrame, k: int = 20) -> DataFrame:
    return samples.groupBy("camera").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "camera").limit(k)


def class_shares(annotations: DataFrame) -> DataFrame:
    """Verified boxes per class and their share of the largest class."""
    counts = annotations.where("verified = 1").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.max("n").over(Window.partitionBy()))  # one row per class


def label_universe(predictions: DataFrame, truths: DataFrame) -> DataFrame:
    return predictions.select("label").union(truths.select("label")).distinct().orderBy("label")


def scatter_points(candidates: DataFrame) -> DataFrame:
    """Candidates with finite latency and accuracy."""
    def finite(c: str) -> Column:
        return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    return candidates.where(finite("latency_ms") & finite("map50"))


def curve_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text cells as numbers; empty, nan and inf become null."""
    number = {c: F.col(c).try_cast("double") for c in columns}
    return df.withColumns({c: F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v) for c, v in number.items()})


def training_index(curves: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Per run: last and best value ignoring nulls, the best epoch, the number of epochs, and has_weights: whether ``weights`` (run) lists it."""
    from ..functions.labels import run_name

    known = F.col("map50").isNotNull()
    out = curves.groupBy("run").agg(
        F.max(F.when(known, F.struct("epoch", "map50")))["map50"].alias("latest_map50"),
        F.max("map50").alias("best_map50"),
        F.min(F.when(known, F.struct((-F.col("map50")).alias("v"), "epoch")))["epoch"].alias("best_epoch"),
        F.countDistinct("epoch").alias("epochs"),
    )
    has = F.lit(None).cast("boolean")
    if weights is not None:
        out = out.join(weights.select("run").distinct().withColumn("_weights", F.lit(True)).hint("merge"), "run", "left")
        has = F.coalesce("_weights", F.lit(False))
    return out.withColumns({"model": run_name(F.col("run"))["model"], "tag": run_name(F.col("run"))["tag"], "has_weights": has}).drop("_weights")


def before_after(before: DataFrame, after: DataFrame, measures=("map50", "recall", "latency_ms")) -> DataFrame:
    """Values of two runs by name and their differences, rounded to four places; non-finite becomes null."""
    def clean(c: Column) -> Column:
        return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)

    a = before.select("name", *[clean(F.col(m)).alias(f"before_{m}") for m in measures])
    b = after.select("name", *[clean(F.col(m)).alias(f"after_{m}") for m in measures])
    return a.join(b, "name", "full").withColumns({f"delta_{m}": F.round(F.col(f"after_{m}") - F.col(f"before_{m}"), 4) for m in measures})


def deployments_newest(ledger: DataFrame) -> DataFrame:
    """The deployment ledger, newest first, with parsed JSON; bad JSON becomes null."""
    from ..functions.labels import tolerant_json

    return ledger.withColumns({"metrics": tolerant_json(F.col("metrics_json")), "reasons": tolerant_json(F.col("reasons_json"))}).orderBy(F.desc("created_at"), "id")


def dataset_listing(versions: DataFrame, summaries: DataFrame) -> DataFrame:
    """Dataset versions newest first with their build summaries; an error text where there is none."""
    joined = versions.join(summaries, "version", "left")
    return joined.withColumn("error", F.when(F.col("built_at").isNull(), "missing or unreadable build summary")).orderBy(F.desc("version"))


def collect_summary(reviews: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row for a collection run: reviews, events, new, duplicate, merged, failed, skipped, annotations. ``outcomes`` has a row per
    event with its outcome and the number of annotations that it added."""
    named = [F.count_if(F.col("outcome") == n).alias(n) for n in ("new", "duplicate", "merged", "failed", "skipped")]
    sums = outcomes.agg(F.count(F.lit(1)).alias("events"), *named, F.coalesce(F.sum("annotations"), F.lit(0)).alias("annotations"))
    return reviews.agg(F.count(F.lit(1)).alias("reviews")).crossJoin(F.broadcast(sums))  # one row each


def outcome_counts(outcomes: DataFrame, names: list[str], column: str = "outcome") -> DataFrame:
    """One row with the number of rows of each outcome, zeros kept (collect, verify, build and import summaries)."""
    return outcomes.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(column) == n).alias(n) for n in names])
