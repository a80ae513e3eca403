"""Exact and near duplicates of frames, and greedy removal of overlapping boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import boxes
from ..lineage import discard, written
from . import nearhash, ranges

SOURCE_RANK = {"vlm": 0, "human": 1, "external": 2, "feed": 3}


def exact_duplicates(samples: DataFrame) -> DataFrame:
    """Adds first_id: the earliest sample of the camera with the same content hash (itself without a hash)."""
    known = samples.where("image_hash is not null").groupBy(F.col("camera").alias("_c"), F.col("image_hash").alias("_h"))
    firsts = written(known.agg(F.min(F.struct("created_at", "id")).alias("_first")))
    out = samples.join(firsts.hint("merge"), F.col("camera").eqNullSafe(F.col("_c")) & (F.col("image_hash") == F.col("_h")), "left")
    return out.withColumn("first_id", F.when(F.col("_h").isNull(), F.col("id")).otherwise(F.col("_first.id"))).drop("_c", "_h", "_first")


def hash_classes(frames: DataFrame, block: str = "camera") -> DataFrame:
    """(camera, hash, n, first): the different hashes of each camera, how many frames have them, and the first of these by
    (ts, event_id, frame_index, id). A frame belongs to the class of its own camera and hash; frames without a hash to none."""
    place = F.struct("ts", "event_id", "frame_index", "id")
    return frames.where("hash is not null").groupBy(block, "hash").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))


def suppress_duplicates(frames: DataFrame, threshold: int = 10, block: str = "camera", bits: int = 64, **options) -> DataFrame:
    """Adds kept: going through a camera's frames in order, a frame stays if no kept earlier one lies within ``threshold`` bits.

    ``frames`` has id, hash, the block column, and order columns ts, event_id, frame_index. Only the first frame of a class of equal
    hashes can stay: if another one drops it, that one drops its class. The classes go through ``nearhash.kept_hashes``. Frames without
    a hash stay.
    """
    classes = written(hash_classes(frames, block))
    stay = nearhash.kept_hashes(classes, threshold, block, bits, **options).select(F.col(block).alias("_b"), F.col("hash").alias("_h"))
    firsts = classes.join(stay.hint("merge"), F.col(block).eqNullSafe(F.col("_b")) & (F.col("hash") == F.col("_h")))
    firsts = written(firsts.select("_b", "_h", F.col("first.id").alias("_first")))
    discard(classes)
    out = frames.join(firsts.hint("merge"), F.col(block).eqNullSafe(F.col("_b")) & (F.col("hash") == F.col("_h")), "left")
    kept = F.col("hash").isNull() | F.col("id").eqNullSafe(F.col("_first")) & F.col("_h").isNotNull()
    return out.withColumn("kept", F.coalesce(kept, F.lit(False))).select(*frames.columns, "kept")


def overlap_priority(source: Column) -> Column:
    out = F.lit(10)
    for name, rank in SOURCE_RANK.items():
        out = F.when(source == name, F.lit(rank)).otherwise(out)
    return out


def without_overlaps(annotations: DataFrame, limit: float = 0.5) -> DataFrame:
    """Greedy removal per sample and label: verified first, then by source, creation and id; a box goes if it overlaps a
    chosen one of the same label by more than ``limit``. Boxes with missing coordinates overlap nothing."""
    columns = [c for c in annotations.columns]
    item = F.struct((-F.col("verified")).alias("o1"), overlap_priority(F.col("source")).alias("o2"), F.col("created_at").alias("o3"), F.col("id").alias("o4"), F.struct(*columns).alias("row"))
    grouped = annotations.groupBy("sample_id", "label").agg(F.sort_array(F.collect_list(item)).alias("rows"))
    rows = F.transform("rows", lambda r: r["row"])

    def clear(chosen: Column, r: Column) -> Column:
        a = boxes.box(r["x1"], r["y1"], r["x2"], r["y2"])
        hit = F.exists(chosen, lambda c: F.coalesce(boxes.iou(boxes.box(c["x1"], c["y1"], c["x2"], c["y2"]), a) > limit, F.lit(False)))
        return ~hit

    whole = lambda r: r["x1"].isNotNull() & r["y1"].isNotNull() & r["x2"].isNotNull() & r["y2"].isNotNull()
    chosen = F.aggregate(rows, F.filter(rows, lambda r: F.lit(False)), lambda acc, r: F.when(~whole(r) | clear(F.filter(acc, whole), r), F.concat(acc, F.array(r))).otherwise(acc))
    return grouped.select(F.inline(chosen))


def best_annotations(annotations: DataFrame, verified_only: bool) -> DataFrame:
    """All verified rows, or verified and unverified without overlaps."""
    return annotations.where("verified = 1") if verified_only else without_overlaps(annotations)


def cap_per_class(items: DataFrame, most: int) -> DataFrame:
    """Adds within_cap: the first ``most`` boxes of each class in order of camera, time, sample and annotation, by equi-depth ranges."""
    order = [F.col(c).asc() for c in ("camera", "ts", "sample_id", "id")]
    return ranges.ranked(items, ["label"], order, "_r").withColumn("within_cap", F.col("_r") <= most).drop("_r")


def best_per_prompt(detections: DataFrame) -> DataFrame:
    """The best detection of each object and prompt class: score, then mask area, then index."""
    w = Window.partitionBy("object_id", "prompt").orderBy(F.desc("score"), F.desc("mask_area"), "idx")
    return detections.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def best_across_prompts(detections: DataFrame) -> DataFrame:
    """The best of an object's prompt classes: score, then the feed's own class, then the order of candidates."""
    own = F.when(F.col("prompt") == F.col("feed_label"), 0).otherwise(1)
    w = Window.partitionBy("object_id").orderBy(F.desc("score"), own, "candidate_order")
    return best_per_prompt(detections).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def clean_detections(detections: DataFrame, least: float, width: Column, height: Column) -> DataFrame:
    """Boxes clipped to the image; invalid ones, empty masks and low scores go."""
    out = detections.withColumn("box", boxes.clip(F.col("box"), width, height))
    return out.where(boxes.is_valid(F.col("box")) & (F.col("mask_area") > 0) & (F.col("score") >= least))


def merge_events(annotations: DataFrame, frames: DataFrame) -> DataFrame:
    """New annotations for events whose frame equals a stored one, unless (sample, event) has one already."""
    known = annotations.select("sample_id", "event_id").where("event_id is not null")
    return frames.join(known, ["sample_id", "event_id"], "left_anti").dropDuplicates(["sample_id", "event_id"])


def without_known_events(events: DataFrame, samples: DataFrame, annotations: DataFrame, most: int | None = None) -> DataFrame:
    """Events in neither table; optionally the first ``most`` of them in order."""
    known = samples.select("event_id").union(annotations.select("event_id")).where("event_id is not null").distinct()
    fresh = events.join(known, events["id"] == known["event_id"], "left_anti")
    return fresh.orderBy("start_time", "id").limit(most) if most is not None else fresh
