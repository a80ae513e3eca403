"""Audits by state: an object, its segment and its verdict may come in any order, and each object has one row in the target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType

from ..lineage import discard, written
from ..operators import reconcile
from ..operators.store import Store

OBJECT = "sample_hash string, sam_key string, vlm_key string, pipeline_version string, feed_label string"
SEGMENT = "seg_class string, seg_box struct<x1: double, y1: double, x2: double, y2: double>, seg_area double"
VERDICT = "covers boolean, vlm_label string, vlm_error string"
#: Order of the parts in an object's state; of each the text, its time and its mark. A bucket's objects are JSON text.
PARTS = ("object", "segment", "verdict")
STATE = "objects string"
#: Buckets of objects. A step of the state takes about a millisecond, however many objects it holds; a bucket is rewritten whole when one of its objects changes.
BUCKETS = 1 << 16
#: State lies on the executors' disks; the stores of an executor share 128 MB. Spark's default store holds two versions of all objects in memory.
STORES = "spark.sql.streaming.stateStore."
ON_DISK = {f"{STORES}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", f"{STORES}rocksdb.boundedMemoryUsage": "true", f"{STORES}rocksdb.maxMemoryUsageMB": "128"}
SETTLED = "object_id string, object string, segment string, verdict string, day string, attempt int"


def _part(df: DataFrame, kind: str, schema: str, mark: Column) -> DataFrame:
    """A feed's rows in the common form: the fields as JSON text, the time (null first) and a mark that the state reads."""
    text = F.to_json(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)]))
    return df.select("object_id", F.lit(kind).alias("kind"), text.alias("text"), F.coalesce(F.unix_micros("at"), F.lit(-(1 << 62))).alias("at"), mark.alias("mark"))


def _settle(wait_ms: int):
    """The state's step for one bucket of objects: what is new goes in, and a row comes out for each object whose decision may have changed."""

    def step(held, news):
        """(state of the object, attempt of its row or None, the row's parts): ``news`` are its rows, or None when it has waited."""
        object_, segment, verdict = held[0:3], held[3:6], held[6:9]
        phase, attempt = held[9], held[10]
        if news is None:
            attempt += 1
            parts = [object_[0], segment[0], verdict[0], object_[2]]
            if phase == "open":  # what is missing by now counts as failed
                phase, segment, verdict = "final", [None] * 3, [None] * 3
            return [*object_, *segment, *verdict, phase, attempt], attempt, parts
        places, before = {"object": object_, "segment": segment, "verdict": verdict}, verdict[0:2]
        for kind, text, at, mark in news:
            p, at = places[kind], int(at)
            if phase == "final" and (kind != "object" or text == p[0]):
                continue
            if p[0] is not None and (at, text) <= (p[1], p[0]):
                continue
            if kind == "object" and p[0] is not None:  # another version of the object, in the partition of the first
                mark = p[2]
                if text != p[0]:
                    phase, attempt = "open", 0
            p[:] = [text, at, mark]
        known = segment[0] is not None and (segment[2] != "valid" or verdict[0] is not None)
        if object_[0] is None or phase == "final" or not known:
            return [*object_, *segment, *verdict, phase, attempt], None, None
        parts = [object_[0], segment[0], verdict[0], object_[2]]
        if segment[2] == "valid" and verdict[2] == "transport":
            told = phase == "open" or verdict[0:2] != before
            return [*object_, *segment, *verdict, "pending" if told else phase, attempt], attempt if told else None, parts
        return [*object_, *[None] * 6, "final", attempt], attempt, parts

    def settle(key, frames, state):
        import json

        import pandas as pd

        # of each object its state and the time at which it has waited, none if it does not wait
        objects = json.loads(state.get[0]) if state.exists else {}
        now, news, out = state.getCurrentProcessingTimeMs(), {}, []
        if not state.hasTimedOut:
            for frame in frames:
                for name, *row in zip(*[frame[c] for c in ("object_id", "kind", "text", "at", "mark")]):
                    news.setdefault(name, []).append([None if v is None or v != v else v for v in row])
        late = [name for name, (_, due) in objects.items() if due is not None and due < now and name not in news]
        for name, rows in [*news.items(), *((name, None) for name in late)]:
            held, attempt, parts = step(objects[name][0] if name in objects else [None] * 9 + ["open", 0], rows)
            objects[name] = held, now + wait_ms if held[0] is not None and held[9] != "final" else None
            if attempt is not None:
                out.append((name, *parts, attempt))
        state.update((json.dumps(objects),))
        due = min((d for _, d in objects.values() if d is not None), default=None)
        if due is not None:
            state.setTimeoutDuration(max(1, due - now))
        yield pd.DataFrame(out, columns=["object_id", "object", "segment", "verdict", "day", "attempt"])

    return settle


def settled(objects: DataFrame, segments: DataFrame, verdicts: DataFrame, wait: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """The streams' objects whenever they may be decided anew: with segment and verdict, or after ``wait`` without news.

    objects: object_id, at, day and the fields of OBJECT; segments and verdicts: object_id, at and their fields. Of rows of one object the newest
    counts, equal times by text; rows without an id are left out. State holds an object's open evidence, and for a decided one its own fields only: later
    evidence changes nothing until the object comes with other fields. A verdict that failed in transport leaves the object pending; every ``wait`` it comes
    again, its attempts counted. Objects are held in ``buckets`` by a hash of their id, some hundred objects in each; a checkpoint keeps the number it began with.
    """
    valid = F.when(reconcile.segment_is_valid(F.col("seg_class"), F.col("seg_box"), F.col("seg_area")), "valid")
    absent = F.col("covers").isNull() | F.col("vlm_label").isNull()
    parts = _part(objects, "object", OBJECT, F.col("day")).union(_part(segments, "segment", SEGMENT, valid)).union(_part(verdicts, "verdict", VERDICT, F.when(absent & (F.col("vlm_error") == "transport"), "transport")))
    wait_ms = max(1, int(objects.sparkSession.sql(f"SELECT unix_millis(timestamp'1970-01-01 00:00:00Z' + interval {wait})").first()[0]))
    return parts.where("object_id is not null").withColumn("bucket", F.pmod(F.xxhash64("object_id"), F.lit(buckets))).groupBy("bucket").applyInPandasWithState(_settle(wait_ms), SETTLED, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def audit_states(spark: SparkSession, objects: DataFrame, segments: DataFrame, verdicts: DataFrame, target: str, checkpoint: str, wait: str = "10 minutes", vocabulary: list[str] | None = None, trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Keeps one decision per object in a copy-on-write table with a partition for each day of objects; a batch rewrites the days of its objects only.

    A batch that is run again gives the same table. With the default trigger the query ends with its input, and objects that wait are looked at when it is
    started again with new input. State is kept on the executors' disks (``ON_DISK``); a checkpoint keeps the kind of store that it began with.
    """
    table = Store(spark, target, "day")

    def store(batch: DataFrame, number: int) -> None:
        whole = batch.select("object_id", "day", "attempt", F.from_json("object", OBJECT).alias("o"), F.from_json("segment", SEGMENT).alias("s"), F.from_json("verdict", VERDICT).alias("v"))
        decided = reconcile.decide_joined(whole.select("object_id", "day", "attempt", "o.*", "s.*", "v.*"), vocabulary)
        new = written(decided.select("object_id", "sample_hash", "sam_key", "vlm_key", "pipeline_version", "feed_label", "status", "reason", "failing_conditions", "training_label", "attempt", "day"))
        if not table.version():
            table.create(new)
        else:
            table.rewrite(new, lambda rows: rows.join(new.select("object_id").hint("merge"), "object_id", "left_anti").select(*new.columns).union(new))
            table.drop_old(2)
        discard(new)

    trigger = trigger or {"availableNow": True}
    out = settled(objects, segments, verdicts, wait, buckets).writeStream.outputMode("append").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**trigger)
    # a query keeps the settings it was started with: batches without rows, which timers ask for, would never let one end that ends with its input
    settings = ON_DISK | ({"spark.sql.streaming.noDataMicroBatches.enabled": "false"} if "availableNow" in trigger else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        return out.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
