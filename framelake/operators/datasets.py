"""Versioned dataset and golden-set building (B rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashes, times
from . import dedup, pool

RATIOS = {"train": 0.8, "val": 0.1, "test": 0.1}


def label_line(class_id: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """``class cx cy w h`` with six decimals, from a normalized box."""
    return F.format_string("%d %.6f %.6f %.6f %.6f", class_id, (x1 + x2) / 2, (y1 + y2) / 2, x2 - x1, y2 - y1)


def label_bodies(boxes: DataFrame, key: str = "sample_id") -> DataFrame:
    """One label text per image, lines in order of annotation id."""
    line = F.struct("id", label_line(F.col("class_id"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")).alias("line"), "label")
    grouped = boxes.groupBy(key).agg(F.sort_array(F.collect_list(line)).alias("_l"))
    return grouped.select(key, F.array_join("_l.line", "\n").alias("body"), F.sort_array(F.array_distinct("_l.label")).alias("labels"))


def build_outcomes(samples: DataFrame, annotations: DataFrame, classes: DataFrame, images: DataFrame | None = None, verified_only: bool = False, max_per_class: int | None = None, seed: str = "1", ratios=RATIOS, **selection) -> DataFrame:
    """One row per selected sample: outcome (no_box, class, cap, no_image or written), and for written ones split, label body
    and labels. The cap counts boxes of samples whose image is missing, as the image is looked for last."""
    chosen = pool.build_selection(samples, annotations, **selection)
    own = annotations.join(chosen.select(F.col("id").alias("sample_id"), "camera", "ts").hint("merge"), "sample_id")
    best = dedup.best_annotations(own, verified_only)
    usable = pool.usable_boxes(best, classes)
    capped = dedup.cap_per_class(usable, max_per_class) if max_per_class is not None else usable.withColumn("within_cap", F.lit(True))
    some = best.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_best"))
    fit = capped.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_usable"), F.count_if("within_cap").alias("n_kept"))
    bodies = label_bodies(capped.where("within_cap"))
    out = chosen.withColumnRenamed("id", "sample_id")
    for part in (some, fit, bodies):
        out = out.join(part.hint("merge"), "sample_id", "left")
    has = F.lit(True)
    if images is not None:
        out = out.join(images.select("image_path").distinct().withColumn("_image", F.lit(True)), "image_path", "left")
        has = F.coalesce("_image", F.lit(False))
    outcome = (
        F.when(F.coalesce("n_best", F.lit(0)) == 0, "no_box").when(F.coalesce("n_usable", F.lit(0)) == 0, "class").when(F.col("n_kept") == 0, "cap").when(~has, "no_image").otherwise("written")
    )
    out = out.withColumn("outcome", outcome).drop("_image")
    written = F.col("outcome") == "written"
    return out.withColumns({"split": F.when(written, hashes.assign_split(F.col("sample_id"), ratios, seed)), "body": F.when(written, F.col("body")), "labels": F.when(written, F.col("labels"))})


def build_summary(outcomes: DataFrame) -> DataFrame:
    """One row: totals by outcome, and the written samples by split as a map."""
    names = {"written": "written", "no_box": "skipped_no_box", "class": "skipped_class", "cap": "skipped_cap", "no_image": "skipped_no_image"}
    sums = [F.count_if(F.col("outcome") == k).alias(v) for k, v in names.items()]
    splits = [F.struct(F.lit(s).alias("k"), F.count_if(F.col("split") == s).alias("v")) for s in ("train", "val", "test")]
    return outcomes.agg(F.count(F.lit(1)).alias("total"), *sums, F.count_if((F.col("outcome") == "written") & (F.col("verified") == 1)).alias("verified"), F.map_from_entries(F.array(*splits)).alias("split_counts"))


def manifest(outcomes: DataFrame) -> DataFrame:
    """Manifest rows of the written samples."""
    return outcomes.where("outcome = 'written'").select("sample_id", F.col("image_path").alias("image"), "camera", F.col("ts").alias("timestamp"), "split", "verified", "labels", "created_at")


def split_lists(ids: DataFrame, ratios=RATIOS, seed: str = "1") -> DataFrame:
    """Rows (split, id) in order; empty splits have none."""
    return ids.select(hashes.assign_split(F.col("id"), ratios, seed).alias("split"), "id").orderBy("split", "id")


def split_counts(ids: DataFrame, ratios=RATIOS, seed: str = "1") -> DataFrame:
    return ids.groupBy(hashes.assign_split(F.col("id"), ratios, seed).alias("split")).agg(F.count(F.lit(1)).alias("n"))


def build_from_audit(positives: DataFrame, negatives: DataFrame, lines: DataFrame, records: DataFrame, ratios=RATIOS, seed: str = "1") -> DataFrame:
    """Samples of an audit export: bad label lines are gone from ``lines``; positives without any are left out; hard negatives
    go to train with an empty body."""
    body = F.struct("line_no", "line")
    texts = lines.groupBy("sample_id").agg(F.sort_array(F.collect_list(body)).alias("_b")).select("sample_id", F.array_join("_b.line", "\n").alias("body"))
    good = positives.join(texts.hint("merge"), "sample_id").withColumn("split", hashes.assign_split(F.col("sample_id"), ratios, seed)).select("sample_id", "split", "body")
    bad = negatives.select("sample_id", F.lit("train").alias("split"), F.lit("").alias("body"))
    return good.union(bad).join(records.select("sample_id", "camera", "timestamp"), "sample_id", "left")


def build_golden(samples: DataFrame, lines: DataFrame, present: DataFrame, classes: DataFrame, split: str = "test", ratios=RATIOS, seed: str = "1") -> DataFrame:
    """Samples of one split that are not in the golden set yet and whose lines are all good and of configured classes, remapped by name."""
    fresh = samples.where(hashes.assign_split(F.col("sample_id"), ratios, seed) == split).join(present.select("sample_id"), "sample_id", "left_anti")
    named = lines.join(F.broadcast(classes.select("label", F.col("class_id").alias("new_id"))), "label", "left")
    whole = named.groupBy("sample_id").agg(F.every(F.col("valid") & F.col("new_id").isNotNull()).alias("ok"), F.sort_array(F.collect_list(F.struct("line_no", "new_id", "rest"))).alias("_l"))
    text = F.array_join(F.transform("_l", lambda x: F.concat(x["new_id"].cast("string"), F.lit(" "), x["rest"])), "\n")
    return fresh.join(whole.where("ok").hint("merge"), "sample_id").select("sample_id", text.alias("body"), F.size("_l").alias("boxes"))


IMAGE_TYPES = ("jpg", "jpeg", "png", "bmp", "webp")


def append_golden(manifest_rows: DataFrame, images: DataFrame, zone: str = "UTC") -> tuple[DataFrame, DataFrame]:
    """(rows to append, rejects with reason): known image types only, no known or repeated id; the time bucket by default from the time."""
    typed = images.withColumn("_type", F.lower(F.regexp_extract("image", r"\.([^.]+)$", 1)))
    counted = typed.join(typed.groupBy("sample_id").agg(F.count(F.lit(1)).alias("_n")), "sample_id", "left")
    known = counted.join(manifest_rows.select("sample_id").distinct().withColumn("_known", F.lit(True)), "sample_id", "left")
    reason = F.when(F.col("sample_id").isNull(), "missing_id").when(~F.col("_type").isin(*IMAGE_TYPES), "image_type").when(F.col("_known") | (F.col("_n") > 1), "duplicate_id")
    out = known.withColumn("reason", reason).withColumn("time_bucket", F.coalesce("time_bucket", times.time_bucket(F.col("timestamp"), zone)))
    own = images.columns
    return out.where("reason is null").select(*own), out.where("reason is not null").select(*own, "reason")


def validate_golden(rows: DataFrame, images: DataFrame, labels: DataFrame) -> DataFrame:
    """Problem rows (sample_id, problem): missing id, duplicate id, missing image, missing label."""
    own = rows.where("sample_id is not null")
    parts = [
        rows.where("sample_id is null").select("sample_id", F.lit("missing_id").alias("problem")),
        own.groupBy("sample_id").count().where("count > 1").select("sample_id", F.lit("duplicate_id").alias("problem")),
        own.join(images.select("image").distinct().hint("merge"), "image", "left_anti").select("sample_id", F.lit("missing_image").alias("problem")),
        own.join(labels.select("sample_id").hint("merge"), "sample_id", "left_anti").select("sample_id", F.lit("missing_label").alias("problem")),
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def golden_summary(lines: DataFrame, names: DataFrame, images: DataFrame) -> DataFrame:
    """Boxes per class over files whose lines are all good, and the number of images; unnamed ids read class-N."""
    whole = lines.groupBy("file").agg(F.every("valid").alias("ok"))
    good = lines.join(whole.where("ok").hint("merge"), "file")
    counts = good.join(F.broadcast(names), "class_id", "left").groupBy(F.coalesce("label", F.concat(F.lit("class-"), F.col("class_id").cast("string"))).alias("label")).agg(F.count(F.lit(1)).alias("boxes"))
    return counts.crossJoin(F.broadcast(images.agg(F.count(F.lit(1)).alias("images"))))  # one row
