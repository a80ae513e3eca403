"""Review, event and motion feeds from JSON files, with rejects instead of exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import boxes, times


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    return parse_reviews(_read(spark, path, schemas.REVIEW_FEED))


def parse_reviews(raw: DataFrame) -> DataFrame:
    """Typed reviews: severity detection by default, missing thumb_path empty, missing start 0, data that is no object null."""
    out = raw.where("_corrupt_record is null") if "_corrupt_record" in raw.columns else raw
    is_object = F.schema_of_variant("data").startswith("OBJECT")
    return out.select(
        F.coalesce("id", F.lit("")).alias("id"), F.coalesce("camera", F.lit("")).alias("camera"), F.coalesce("severity", F.lit("detection")).alias("severity"),
        F.coalesce("thumb_path", F.lit("")).alias("thumb_path"), F.coalesce(times.unix_seconds(F.col("start_time")), F.lit(0.0)).alias("start_time"),
        times.unix_seconds(F.col("end_time")).alias("end_time"), F.when(is_object, F.col("data")).alias("data"), F.coalesce("zones", F.array().cast("array<string>")).alias("zones"),
    )


def _number(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return parse_events(_read(spark, path, schemas.EVENT_FEED))


def parse_events(raw: DataFrame) -> DataFrame:
    """Typed events: box from ``box``, else ``data.box`` (xywh), score from ``data.score``, else ``score``; bad numbers become null."""
    out = raw.where("_corrupt_record is null") if "_corrupt_record" in raw.columns else raw
    data = F.try_parse_json("data")
    inner = F.try_variant_get(data, "$.box", "array<double>")
    return out.select(
        F.coalesce("id", F.lit("")).alias("id"), F.coalesce("camera", F.lit("")).alias("camera"), F.coalesce("label", F.lit("")).alias("label"),
        F.coalesce(times.unix_seconds(F.col("start_time")), F.lit(0.0)).alias("start_time"), times.unix_seconds(F.col("end_time")).alias("end_time"),
        _number(F.col("top_score")).alias("top_score"), F.coalesce(_number(F.try_variant_get(data, "$.score", "string")), _number(F.col("score"))).alias("score"),
        "false_positive", F.coalesce("zones", F.array().cast("array<string>")).alias("zones"), "has_clip", "has_snapshot", "sub_label", "plus_id",
        F.coalesce(boxes.from_xywh(F.col("box")), boxes.from_xywh(inner)).alias("box"), F.col("end_time").isNotNull().alias("completed"),
    )


def read_motion(spark: SparkSession, path: str) -> DataFrame:
    return parse_motion(_read(spark, path, schemas.MOTION_FEED))


def parse_motion(raw: DataFrame) -> DataFrame:
    """Motion buckets: rows without a start go, the start is cut to a whole second, missing motion is 0."""
    out = raw.where("_corrupt_record is null") if "_corrupt_record" in raw.columns else raw
    start = F.floor(_number(F.col("start_time"))).cast("long")
    return out.select("camera", start.alias("start_time"), F.coalesce(_number(F.col("motion")), F.lit(0.0)).alias("motion")).where("start_time is not null")


def rejected(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Malformed lines of a feed with the reason."""
    return spark.read.text(path).where("length(trim(value)) > 0").withColumn("ok", F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})).where("ok._corrupt_record is not null").select("value", F.lit("malformed_json").alias("reason"))


def list_reviews(reviews: DataFrame, after=None, before=None, cameras=None, labels=None, zones=None, severities=("alert", "detection"), limit: int | None = None) -> DataFrame:
    """Reviews of a window: the newest ``limit`` of each severity, then one row per id (the earlier severity of the list first)."""
    out = reviews.where(F.col("severity").isin(*severities))
    for given, condition in ((after, lambda: F.col("start_time") >= after), (before, lambda: F.col("start_time") <= before), (cameras, lambda: F.col("camera").isin(cameras)), (zones, lambda: F.arrays_overlap("zones", F.array(*[F.lit(z) for z in zones]))), (labels, lambda: F.arrays_overlap("labels", F.array(*[F.lit(x) for x in labels])))):
        if given is not None:
            out = out.where(condition())
    rank = F.array_position(F.array(*[F.lit(s) for s in severities]), F.col("severity"))
    if limit is not None:
        newest = Window.partitionBy("severity").orderBy(F.desc("start_time"), "id")
        out = out.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= limit).drop("_n")
    first = Window.partitionBy("id").orderBy(rank, F.desc("start_time"), "camera")
    return out.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def list_events(events: DataFrame, after=None, before=None, cameras=None, labels=None, limit: int | None = None) -> DataFrame:
    out = events
    for given, condition in ((after, lambda: F.col("start_time") >= after), (before, lambda: F.col("start_time") <= before), (cameras, lambda: F.col("camera").isin(cameras)), (labels, lambda: F.col("label").isin(labels))):
        if given is not None:
            out = out.where(condition())
    out = out.orderBy(F.desc("start_time"), "id")
    return out.limit(limit) if limit is not None else out


def event_ids(reviews: DataFrame, detections: str | Column = "data") -> DataFrame:
    """(event_id, first) of the reviews' event ids, distinct, with the place where each is first seen.

    ``detections`` is an array of ids, or the variant ``data`` whose detections (else objects) are texts or objects with an id.
    """
    kind = dict(reviews.dtypes)[detections] if isinstance(detections, str) else "array<string>"
    ids = F.col(detections) if isinstance(detections, str) else detections
    if kind == "variant":
        first, second = (F.try_variant_get(ids, p, "array<variant>") for p in ("$.detections", "$.objects"))
        items = F.when(F.size(first) > 0, first).otherwise(second)
        ids = F.transform(items, lambda v: F.coalesce(F.try_variant_get(v, "$.id", "string"), F.when(~F.schema_of_variant(v).startswith("OBJECT"), F.try_variant_get(v, "$", "string"))))
    found = reviews.select(F.col("start_time"), F.col("id").alias("review_id"), F.posexplode(ids).alias("pos", "event_id")).where("event_id is not null and event_id <> ''")
    return found.groupBy("event_id").agg(F.min(F.struct((-F.col("start_time")).alias("t"), "review_id", "pos")).alias("first"))


def plan_frames(events: DataFrame, n: int, min_gap: float = 2.0, sampling: bool = True, crops: bool = False) -> DataFrame:
    """One row per frame: event, frame_index, ts; the frame at the start is the default frame (null). In crop mode, and with sampling off,
    only that one. Events in progress are left to ``refused_events``."""
    done = events.where("end_time is not null")
    single = F.array(F.lit(None).cast("double"))
    frames = single if crops or not sampling else times.frame_times(F.col("start_time"), F.col("end_time"), n, min_gap)
    out = done.select("*", F.posexplode(frames).alias("frame_index", "frame_ts"))
    return out.withColumn("frame_ts", F.when(F.col("frame_ts") != F.col("start_time"), F.col("frame_ts")))


def refused_events(events: DataFrame, crops: bool = False) -> DataFrame:
    """Adds outcome: failed while in progress, skipped in crop mode without a sane box, else ok."""
    sane = boxes.is_sane(F.col("box"))
    return events.withColumn("outcome", F.when(F.col("end_time").isNull(), "failed").when(F.lit(crops) & ~sane, "skipped").otherwise("ok"))
