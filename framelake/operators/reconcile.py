"""Two independent label sources reconciled into keep, drop or pending decisions (X rows of the inventory)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import boxes, labels


@dataclass(frozen=True)
class Gates:
    """Geometry gates; the defaults reject nothing."""

    min_mask_area: float = 0
    min_bbox_iou: float = 0.0
    mask_bbox_ratio_min: float = 0.0
    mask_bbox_ratio_max: float = float("inf")
    min_containment: float = 0.0

    def violations(self, g: Column) -> Column:
        """Names of the gates that fail, in a fixed order; none without geometry."""
        checks = (
            (g["mask_area"] < self.min_mask_area, "mask_area"),
            (g["bbox_iou"] < self.min_bbox_iou, "bbox_iou"),
            (g["mask_bbox_ratio"] < self.mask_bbox_ratio_min, "mask_bbox_ratio_min"),
            (g["mask_bbox_ratio"] > self.mask_bbox_ratio_max, "mask_bbox_ratio_max"),
            (g["mask_feed_containment"] < self.min_containment, "mask_feed_containment"),
        )
        return F.array_compact(F.array(*[F.when(c, n) for c, n in checks]))


def segment_is_valid(seg_class: Column, box: Column, mask_area: Column) -> Column:
    return F.coalesce((F.length(F.trim(seg_class)) > 0) & boxes.is_valid(box) & (mask_area > 0), F.lit(False))


def failing_conditions(covers: Column, vlm_label: Column) -> Column:
    """object_present when the label is blank, bbox_covers when the box does not cover the object."""
    return F.array_compact(F.array(F.when(F.length(F.trim(vlm_label)) == 0, "object_present"), F.when(~covers, "bbox_covers")))


def is_training_sample(valid: Column, covers: Column, vlm_label: Column, seg_class: Column, violations: Column, vocabulary: list[str] | None) -> Column:
    """All teachers agree: valid segment, no failing condition, same canonical class, no gate violated."""
    a, b = labels.canonical_label(vlm_label, vocabulary), labels.canonical_label(seg_class, vocabulary)
    return valid & (F.size(failing_conditions(covers, vlm_label)) == 0) & (a != "") & (a == b) & (F.size(violations) == 0)


def decide(objects: DataFrame, segments: DataFrame, verdicts: DataFrame, vocabulary: list[str] | None = None, gates: Gates = Gates(), geometry: str | None = None) -> DataFrame:
    """One decision per object: status, reason, failing_conditions, training_label.

    objects: object_id, feed_label. segments: object_id, seg_class, seg_box, seg_area and an optional geometry struct.
    verdicts: object_id, covers, vlm_label, vlm_error (transport, malformed or other). A missing verdict is a failure.
    """
    fields = ["object_id", "seg_class", "seg_box", "seg_area", *([geometry] if geometry else [])]
    joined = objects.join(segments.select(*fields), "object_id", "left").join(verdicts.select("object_id", "covers", "vlm_label", "vlm_error"), "object_id", "left")
    return decide_joined(joined, vocabulary, gates, geometry)


def decide_joined(joined: DataFrame, vocabulary: list[str] | None = None, gates: Gates = Gates(), geometry: str | None = None) -> DataFrame:
    """``decide`` where every object's segment and verdict stand in its row, null if missing."""
    valid = segment_is_valid(F.col("seg_class"), F.col("seg_box"), F.col("seg_area"))
    absent = F.col("covers").isNull() | F.col("vlm_label").isNull()
    a, b = labels.canonical_label(F.col("vlm_label"), vocabulary), labels.canonical_label(F.col("seg_class"), vocabulary)
    present = F.length(F.trim("vlm_label")) > 0
    mismatch = F.array_compact(F.array(F.when(present & ((a == "") | (a != b)), "class_mismatch")))
    failing = F.concat(failing_conditions(F.col("covers"), F.col("vlm_label")), mismatch)
    broken = gates.violations(F.col(geometry)) if geometry else F.array().cast("array<string>")
    joined = joined.withColumns({"_valid": valid, "_failing": failing, "_broken": F.coalesce(broken, F.array().cast("array<string>"))})
    both = F.concat("_failing", F.transform("_broken", lambda v: F.concat(F.lit("geometry:"), v)))
    reason = (
        F.when(~F.col("_valid"), "sam_failure")
        .when(absent & (F.col("vlm_error") == "malformed"), "vlm_malformed")
        .when(absent, "vlm_failure")
        .when(F.size("_failing") > 0, "vlm_conditions")
        .when(F.size("_broken") > 0, "sam_geometry")
    )
    status = F.when(F.col("_valid") & absent & (F.col("vlm_error") == "transport"), "PENDING").when(reason.isNull(), "KEEP").otherwise("DROP")
    out = joined.withColumns({"reason": reason, "status": status})
    keep, met = F.col("status") == "KEEP", F.col("_valid") & ~absent
    return out.withColumns(
        {"failing_conditions": F.when(met, both).otherwise(F.array().cast("array<string>")), "training_label": F.when(keep, F.col("feed_label")), "sam_class": F.when(F.col("_valid"), F.col("seg_class"))}
    ).drop("_valid", "_failing", "_broken")


def apply_overrides(decisions: DataFrame, overrides: DataFrame) -> DataFrame:
    """Human KEEP and DROP replace the status; the pipeline's own is kept. Other override values are ignored."""
    valid = overrides.where(F.col("status").isin("KEEP", "DROP")).select("object_id", F.col("status").alias("override"))
    out = decisions.join(valid, "object_id", "left").withColumn("pipeline_status", F.col("status"))
    reason = F.when(F.col("override").isNull(), F.col("reason")).when(F.col("override") == "DROP", "human_override")
    return out.withColumns({"reason": reason, "status": F.coalesce("override", "status")})


def provenance(decisions: DataFrame) -> DataFrame:
    """Nested record per object, as a struct and as JSON text."""
    record = F.struct(
        F.struct("object_id", F.col("feed_label").alias("class_name")).alias("source"),
        F.struct(F.col("seg_class").alias("class_name"), F.col("seg_area").alias("mask_area")).alias("sam"),
        F.struct(F.col("covers").alias("bbox_covers_object"), F.col("vlm_label").alias("class_label"), F.col("vlm_error").alias("error")).alias("vlm"),
        F.struct("status", "reason", "failing_conditions").alias("decision"),
    )
    return decisions.withColumn("provenance", record).withColumn("provenance_json", F.to_json("provenance"))


def audit_statistics(decisions: DataFrame, view: str = "dashboard") -> DataFrame:
    """Counts over all (label null) and per label, with the acceptance rate; blank labels read "unknown" in the dashboard view."""
    name = F.when(F.length(F.coalesce("feed_label", F.lit(""))) == 0, "unknown").otherwise(F.col("feed_label")) if view == "dashboard" else F.col("feed_label")
    status, reason = F.col("status"), F.coalesce("reason", F.lit(""))
    failed = reason.isin("vlm_failure", "vlm_malformed") & (status == "DROP")
    ok = (status != "DROP") | (F.length(F.coalesce("sam_class", F.lit(""))) > 0)
    called = (status == "KEEP") | ((status == "DROP") & reason.contains("vlm") & ~failed)
    sums = {
        "processed": F.count(F.lit(1)), "accepted": F.count_if(status == "KEEP"), "dropped": F.count_if(status == "DROP"), "pending": F.count_if(status == "PENDING"),
        "sam_ok": F.count_if(ok), "sam_fail": F.count_if((status == "DROP") & (reason == "sam_failure")), "vlm_calls": F.count_if(called), "vlm_fail": F.count_if(failed),
        "vlm_transport": F.count_if(status == "PENDING"),
    }
    out = decisions.withColumn("label", name).rollup("label").agg(F.grouping("label").alias("overall"), *[v.alias(k) for k, v in sums.items()])
    return out.withColumn("acceptance_rate", F.round(F.col("accepted") / F.col("processed"), 4))


def decision_index(decisions: DataFrame, status=None, label=None) -> DataFrame:
    out = decisions
    if status is not None:
        out = out.where(F.col("status") == status)
    return out.where(F.col("feed_label") == label) if label is not None else out


def decision_details(decisions: DataFrame) -> DataFrame:
    """Adds has_sam, has_vlm and vlm_error (not the marker of a failed segment)."""
    return decisions.withColumns({"has_sam": F.coalesce(F.length("seg_class") > 0, F.lit(False)), "has_vlm": F.col("covers").isNotNull(), "vlm_error": F.nullif(F.col("vlm_error"), F.lit("sam"))})


def index_labels(decisions: DataFrame) -> DataFrame:
    """Labels and the newest update, for the decision index."""
    return decisions.agg(F.sort_array(F.collect_set("feed_label")).alias("labels"), F.max("updated_at").alias("updated_at"))


def audit_index(decisions: DataFrame, status=None, label=None, limit: int = 100, offset: int = 0) -> DataFrame:
    """The decision index as one row: the page of matching decisions by object_id, their total, the statistics of all decisions, the
    labels and the newest update. The page holds ``limit`` decisions, 1 to 200; statistics have a row per label."""
    found = decision_index(decisions, status, label)
    page = found.orderBy("object_id").offset(max(0, offset)).limit(min(200, max(1, limit))).agg(F.sort_array(F.collect_list(F.struct("object_id", "feed_label", "status", "reason"))).alias("page"))
    statistics = audit_statistics(decisions)
    nested = statistics.agg(F.sort_array(F.collect_list(F.struct(*statistics.columns))).alias("statistics"))
    parts = [found.agg(F.count(F.lit(1)).alias("total")), nested, index_labels(decisions)]
    for part in parts:  # one row each
        page = page.crossJoin(F.broadcast(part))
    return page


def unresolved(objects: DataFrame, cached: DataFrame, teacher_available: bool = True) -> DataFrame:
    """Objects to decide: those without a final KEEP or DROP of the same five keys that is not stale."""
    keys = ["object_id", "sample_hash", "sam_key", "vlm_key", "pipeline_version"]
    final = cached.where(F.col("status").isin("KEEP", "DROP") & ~stale(teacher_available))
    return objects.join(final.select(*keys), keys, "left_anti")


def stale(teacher_available: bool) -> Column:
    """Cached rows to redo: segment failures from a time without the teacher, and verdicts without the two blind fields."""
    kind = F.coalesce("error_kind", F.lit("import"))
    segment = (F.col("status") == "DROP") & (F.col("reason") == "sam_failure") & (kind != "run") & F.lit(teacher_available)
    blind = F.col("has_covers") | F.col("has_class_label")
    verdict = (F.coalesce("vlm_error", F.lit("")) != "sam") & ~F.coalesce(blind, F.lit(False))
    return F.coalesce(segment, F.lit(False)) | verdict


def reuse_results(objects: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a cached result of the same sample, hash and model key, rows to score)."""
    on = ["object_id", "sample_hash", key]
    return objects.join(cache, on), objects.join(cache.select(*on), on, "left_anti")


def objects_to_audit(objects: DataFrame, classes=None, cached: DataFrame | None = None, limit: int | None = None, images: DataFrame | None = None) -> DataFrame:
    """Objects of the classes, less the cached ones and those whose image ``images`` (image_path, decodable) does not list as
    decodable; the limit counts the rest only."""
    out = objects.where(F.col("feed_label").isin(classes)) if classes else objects
    if images is not None:
        out = out.join(images.where("decodable").select("image_path"), "image_path", "left_semi").select(*objects.columns)
    if cached is not None:
        out = out.join(cached.select("object_id"), "object_id", "left_anti")
    return out.orderBy("object_id").limit(limit) if limit is not None else out


def hard_negatives(decisions: DataFrame) -> DataFrame:
    return decisions.where((F.col("status") == "DROP") & F.array_contains("failing_conditions", "object_present"))


def background_boxes(objects: DataFrame, per_object: int, size: float = 0.2, tries: int = 16, most_iou: float = 0.2) -> DataFrame:
    """Per object and number the first of ``tries`` seeded square draws that hardly overlaps the object: object_id, n, box.

    A draw is made only if those before it are taken: the first is nearly always free and is a plain expression; the others are steps of a fold, which are
    interpreted.
    """
    top = float(2**53)
    own = boxes.box("x1", "y1", "x2", "y2")

    def drawn(attempt: Column) -> Column:
        x, y = (F.shiftrightunsigned(F.xxhash64(F.col("object_id"), F.col("n"), attempt, F.lit(axis)), 11).cast("double") / top * (1 - size) for axis in (0, 1))
        return boxes.box(x, y, x + size, y + size)

    def free(b: Column) -> Column:
        return boxes.iou(b, own) <= most_iou

    # the draw is a column of its own, or each use of an edge would be another draw
    numbered = objects.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(per_object - 1)))).withColumn("_first", drawn(F.lit(0)))
    none = F.lit(None).cast("struct<x1:double,y1:double,x2:double,y2:double>")
    step = lambda found, a: F.coalesce(found, boxes.let(drawn(a), lambda b: F.when(free(b), b).otherwise(none)))
    others = F.aggregate(F.sequence(F.lit(1), F.lit(tries - 1)), none, step) if tries > 1 else none
    box = F.when(free(F.col("_first")), F.col("_first")).otherwise(others)
    return numbered.withColumn("box", box).where("box is not null").drop("_first")


def frame_export(decisions: DataFrame) -> DataFrame:
    """Accepted objects by frame: one label body and the ids of its objects."""
    line = F.struct("object_id", "label_line")
    grouped = decisions.where("status = 'KEEP'").groupBy("frame_key").agg(F.sort_array(F.collect_list(line)).alias("_l"))
    return grouped.select("frame_key", F.array_join("_l.label_line", "\n").alias("body"), F.col("_l.object_id").alias("object_ids"))


def funnel(statistics: DataFrame) -> DataFrame:
    """Stages of the overall row with their share of the total."""
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("stage"), c.alias("n")) for i, (n, c) in enumerate((("candidates", F.col("processed")), ("segment_ok", F.col("sam_ok")), ("vlm_parsed", F.col("vlm_calls") + F.col("vlm_fail")), ("kept", F.col("accepted"))))])
    return statistics.where("overall = 1").select(F.inline(steps), F.col("processed").alias("_t")).select("step", "stage", "n", (100 * F.col("n") / F.col("_t")).alias("percent"))


def class_bars(statistics: DataFrame) -> DataFrame:
    """Shares of accepted, dropped and pending per class, largest class first."""
    own = statistics.where("overall = 0")
    return own.select("label", "processed", *[(F.col(c) / F.col("processed")).alias(f"{c}_share") for c in ("accepted", "dropped", "pending")]).orderBy(F.desc("processed"), "label")


def last_by(df: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
