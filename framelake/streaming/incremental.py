"""Structured Streaming forms of collection, motion windows and audits; re-runs add nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..lineage import discard, written
from ..operators import reconcile, sessions


#: Bits of a batch's filter for each of its ids, and bits that an id sets.
FILTER_BITS, FILTER_PROBES = 16, 3


def _bit(probe: int, size: Column) -> Column:
    """The place of an id's ``probe``-th bit in a filter of ``size`` bits, a power of two."""
    return F.xxhash64(F.lit(probe), "id").bitwiseAND(size - 1)


def _filter_of(ids: DataFrame, number: int) -> DataFrame:
    """(size, cell, bits, _batch): a Bloom filter over the ids of a batch, 64 bits a cell."""
    n = ids.count()
    size = F.lit(max(64, 1 << (FILTER_BITS * n - 1).bit_length())).cast("long")
    at = ids.select(F.explode(F.array(*[_bit(k, size) for k in range(FILTER_PROBES)])).alias("at"))
    cells = at.groupBy(F.shiftright("at", 6).alias("cell")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits"))
    return cells.select(size.alias("size"), "cell", "bits", F.lit(number).cast("long").alias("_batch"))


def _maybe_known(ids: DataFrame, filters: DataFrame) -> DataFrame:
    """(id, _batch) of all batches whose filter has all bits of an id: those that hold it, and few others."""
    sizes = [r[0] for r in filters.select("size").distinct().collect()]  # powers of two
    probes = [F.struct(F.lit(s).cast("long").alias("size"), F.lit(k).alias("k"), _bit(k, F.lit(s).cast("long")).alias("at")) for s in sizes for k in range(FILTER_PROBES)]
    asked = ids.select("id", F.explode(F.array(*probes) if probes else F.expr("cast(array() as array<struct<size:bigint,k:int,at:bigint>>)")).alias("p"))
    asked = asked.select("id", "p.size", "p.k", "p.at", F.shiftright("p.at", 6).alias("cell"))
    hit = asked.join(filters.hint("merge"), ["size", "cell"]).where(F.expr("bits & shiftleft(1L, cast(at & 63 as int)) <> 0"))
    return hit.groupBy("id", "_batch").agg(F.count_distinct("k").alias("n")).where(F.col("n") == FILTER_PROBES).select("id", "_batch")


def collect_events(spark: SparkSession, stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends new events (id, ...) to a Parquet table with a partition for each batch. There is no watermark: an event of any age is kept, once.

    Repeats of earlier batches are looked up: every batch leaves a Bloom filter of its ids beside the table, a batch asks these filters first, and reads only the partitions
    that may hold one of its ids, and of these only the ids. A batch that is run again replaces its own rows and filter.
    """
    def put(df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path)

    def store(batch: DataFrame, number: int) -> None:
        batch = written(batch.dropDuplicates(["id"]).withColumn("_batch", F.lit(number).cast("long")))
        filters = _table(spark, f"{target}/_filters", "size long, cell long, bits long, _batch long").where(F.col("_batch") != number)
        maybe = written(_maybe_known(batch.select("id"), filters))
        numbers = [r[0] for r in maybe.select("_batch").distinct().collect()]
        known = _table(spark, target, "id string, _batch long").where(F.col("_batch").isin(numbers) if numbers else F.lit(False))
        known = known.join(maybe.hint("merge"), ["id", "_batch"], "left_semi").select("id")
        new = written(batch.join(known.hint("merge"), "id", "left_anti").select(*batch.columns))
        put(new, target)
        put(_filter_of(new.select("id"), number), f"{target}/_filters")
        discard(batch, maybe, new)

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def motion_windows(stream: DataFrame, threshold: float, gap: int = 60, delay: str = "10 minutes") -> DataFrame:
    """Closed windows of a motion stream (camera, ts timestamp, motion), as in the batch form: starts at most gap + 1 seconds apart merge."""
    loud = stream.where(F.col("motion") >= threshold).withWatermark("ts", delay)
    found = loud.groupBy("camera", F.session_window("ts", f"{gap + 1} seconds").alias("w")).agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.max("motion").alias("peak_motion"), F.count(F.lit(1)).alias("buckets"))
    return found.select("camera", F.unix_micros("first") / 1e6, (F.unix_micros("last") / 1e6 + 1.0), "peak_motion", "buckets").toDF("camera", "start", "end", "peak_motion", "buckets")


def store_motion_windows(spark: SparkSession, windows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    def store(batch: DataFrame, number: int) -> None:
        found = batch.withColumn("covered", F.lit(False))
        known = _table(spark, target, "camera string, start double")
        new = sessions.store_windows(known, found).drop("covered").withColumn("_batch", F.lit(number))
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(target)

    return windows.writeStream.outputMode("append").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def audit_objects(spark: SparkSession, stream: DataFrame, segments: DataFrame, verdicts: DataFrame, target: str, checkpoint: str, **options) -> StreamingQuery:
    """Decides the objects of every batch that have no final decision yet (object_id, sample_hash, sam_key, vlm_key, pipeline_version, feed_label)."""
    keys = ["object_id", "sample_hash", "sam_key", "vlm_key", "pipeline_version"]

    def store(batch: DataFrame, number: int) -> None:
        done = _table(spark, target, ", ".join(f"{k} string" for k in keys) + ", status string, _batch long")
        final = done.where(F.col("status").isin("KEEP", "DROP") & (F.col("_batch") != number))
        todo = batch.join(final.select(*keys), keys, "left_anti")
        decided = reconcile.decide(todo.dropDuplicates(keys), segments, verdicts, **options)
        out = decided.select(*keys, "feed_label", "status", "reason", "failing_conditions", "training_label").withColumn("_batch", F.lit(number))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(target)

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The named columns of the table at a path, none before the first batch."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
