import json
import time

from framelake.functions import boxes
from framelake.operators import sessions
from framelake.streaming import audit, incremental
from pyspark.sql import functions as F


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, rows)))


def test_collect_is_idempotent(spark, tmp_path):
    put(tmp_path / "in", "1.json", [{"id": "a", "ts": "2024-01-01T00:00:00Z"}, {"id": "b", "ts": "2024-01-01T00:01:00Z"}, {"id": "a", "ts": "2024-01-01T00:02:00Z"}])
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def go():
        stream = spark.readStream.schema("id string, ts timestamp").json(str(tmp_path / "in"))
        incremental.collect_events(spark, stream, target, checkpoint).awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(target).collect())

    assert go() == ["a", "b"] and go() == ["a", "b"]
    put(tmp_path / "in", "2.json", [{"id": "b", "ts": "2024-01-03T00:00:00Z"}, {"id": "c", "ts": "2024-01-03T00:00:00Z"}])
    assert go() == ["a", "b", "c"]


def test_stream_windows_equal_batch_windows(spark, tmp_path):
    starts = [("front", 100), ("front", 110), ("front", 171), ("front", 400), ("deck", 120), ("deck", 300)]
    day = 1704067200
    put(tmp_path / "in", "1.json", [{"camera": c, "ts": day + s, "motion": 0.5} for c, s in starts] + [{"camera": "front", "ts": day + 5, "motion": 0.1}])
    put(tmp_path / "in", "2.json", [{"camera": "late", "ts": day + 90_000, "motion": 0.9}])
    raw = "camera string, ts double, motion double"
    target = str(tmp_path / "out")
    for _ in range(2):
        stream = spark.readStream.schema(raw).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")).withColumn("ts", F.timestamp_seconds("ts"))
        found = incremental.motion_windows(stream, 0.3, 60)
        incremental.store_motion_windows(spark, found, target, str(tmp_path / "cp")).awaitTermination()
    batch = spark.createDataFrame([(c, day + s, 0.5) for c, s in starts], "camera string, start_time long, motion double")
    want = sorted((r["camera"], r["start"], r["end"], r["buckets"]) for r in sessions.motion_windows(batch, 0.3, 60).collect())
    got = sorted((r["camera"], r["start"], r["end"], r["buckets"]) for r in spark.read.parquet(target).collect())
    assert got == want


def test_audit_decides_only_open_objects(spark, tmp_path):
    keys = {"sample_hash": "h", "sam_key": "s", "vlm_key": "v", "pipeline_version": "1", "feed_label": "car"}
    put(tmp_path / "in", "1.json", [{"object_id": i, **keys} for i in "ab"])
    segments = spark.createDataFrame([(i, "car", 5) for i in "abc"], "object_id string, seg_class string, seg_area int").withColumn("seg_box", boxes.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1)))
    verdicts = spark.createDataFrame([("a", True, "car", None), ("b", None, None, "transport"), ("c", True, "dog", None)], "object_id string, covers boolean, vlm_label string, vlm_error string")
    target = str(tmp_path / "out")

    def go(seen):
        stream = spark.readStream.schema("object_id string, sample_hash string, sam_key string, vlm_key string, pipeline_version string, feed_label string").json(str(tmp_path / "in"))
        incremental.audit_objects(spark, stream, segments, seen, target, str(tmp_path / "cp")).awaitTermination()
        return sorted((r["object_id"], r["status"]) for r in spark.read.parquet(target).collect())

    assert go(verdicts) == [("a", "KEEP"), ("b", "PENDING")]
    put(tmp_path / "in", "2.json", [{"object_id": i, **keys} for i in "abc"])
    later = verdicts.withColumns({"covers": F.lit(True), "vlm_label": F.when(F.col("object_id") == "c", "dog").otherwise("car")})
    assert go(later) == [("a", "KEEP"), ("b", "KEEP"), ("b", "PENDING"), ("c", "DROP")]


def test_late_repeats_are_found_in_few_partitions(spark, tmp_path):
    """Thirty batches of a day each; a late repeat is looked up in the batch that has it."""
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def go():
        stream = spark.readStream.schema("id string, ts timestamp").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        incremental.collect_events(spark, stream, target, checkpoint).awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(target).collect())

    ids = []
    for day in range(1, 7):
        own = [f"d{day}-{i}" for i in range(50)]
        ids += own
        put(tmp_path / "in", f"{day}.json", [{"id": i, "ts": f"2024-01-{day:02d}T00:00:00Z"} for i in own])
    assert go() == sorted(ids)
    filters = spark.read.parquet(f"{target}/_filters")
    asked = spark.createDataFrame([("d2-7",), ("d5-1",), ("new",)], "id string")
    found = sorted(map(tuple, incremental._maybe_known(asked, filters).collect()))
    # files of one moment come in any order, so the batch of a day is read from the table
    held = {(r["id"], r["_batch"]) for r in spark.read.parquet(target).where("id in ('d2-7', 'd5-1')").collect()}
    assert len({b for _, b in held}) == 2 and held <= set(found) and len(found) <= 3
    put(tmp_path / "in", "7.json", [{"id": i, "ts": "2024-01-09T00:00:00Z"} for i in ("d2-7", "d5-1", "new")])
    assert go() == sorted([*ids, "new"])


def test_filters_never_miss(spark):
    ids = spark.range(3000).select(F.concat(F.lit("i"), "id").alias("id"))
    filters = incremental._filter_of(ids, 4).union(incremental._filter_of(ids.limit(0), 5)).union(incremental._filter_of(ids.limit(10), 6))
    found = incremental._maybe_known(ids, filters)
    assert found.where("_batch = 4").count() == 3000 and found.where("_batch = 5").count() == 0 and 10 <= found.where("_batch = 6").count() < 400
    strangers = ids.select(F.concat(F.lit("x"), "id").alias("id"))
    assert incremental._maybe_known(strangers, filters.where("_batch = 4")).count() < 100


def test_audit_states_keep_one_row_an_object(spark, tmp_path):
    """Evidence in any order, restarts between the files, retries of a verdict that failed in transport, and a timer for what never comes."""
    from framelake.operators.store import Store
    from framelake.streaming import audit

    fields = {"sample_hash": "h", "sam_key": "s", "vlm_key": "v", "pipeline_version": "1", "feed_label": "car"}
    at = "2024-01-01T00:00:00Z"
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def object_(i, **other):
        return {"kind": "object", "object_id": i, "at": at, "day": f"2024-01-0{1 + (i == 'b')}", **fields, **other}

    def segment(i, area=5):
        return {"kind": "segment", "object_id": i, "at": at, "seg_class": "car", "seg_box": {"x1": 0.1, "y1": 0, "x2": 1, "y2": 1}, "seg_area": area}

    def verdict(i, label="car", error=None, at=at):
        return {"kind": "verdict", "object_id": i, "at": at, "covers": None if error else True, "vlm_label": None if error else label, "vlm_error": error}

    def go(number, *rows):
        put(tmp_path / "in", f"{number}.json", rows)
        feed = spark.readStream.schema(f"kind string, object_id string, at timestamp, day string, {audit.OBJECT}, {audit.SEGMENT}, {audit.VERDICT}").json(str(tmp_path / "in"))
        audit.audit_states(spark, *[feed.where(F.col("kind") == k) for k in audit.PARTS], target, checkpoint, "1 second").awaitTermination()
        time.sleep(1.2)
        return {r["object_id"]: (r["status"], r["reason"], r["attempt"]) for r in Store(spark, target, "day").read().collect()}

    first = go(1, verdict("a"), object_("a"), segment("a"), object_("b"), segment("b"), verdict("b", error="transport"), segment("c"), object_("d"), object_("d"), segment("f", 0), object_("f"), object_(None))
    assert first == {"a": ("KEEP", None, 0), "b": ("PENDING", "vlm_failure", 0), "f": ("DROP", "sam_failure", 0)}
    files = Store(spark, target, "day").files()
    second = go(2, object_("a"), verdict("a", "dog"), object_("c"), verdict("c", "dog"))
    assert second == first | {"b": ("PENDING", "vlm_failure", 1), "c": ("DROP", "vlm_conditions", 0), "d": ("DROP", "sam_failure", 1)}
    third = go(3, verdict("b", at="2024-01-02T00:00:00Z"), segment("d"), verdict("d"))
    assert third == second | {"b": ("KEEP", None, 1)}
    kept = {f for f in Store(spark, target, "day").files() if "day=2024-01-01" in f}
    assert kept and not kept & files
    fourth = go(4, object_("a", sample_hash="new", at="2024-01-03T00:00:00Z"), segment("a"), verdict("a", "dog"))
    assert fourth == third | {"a": ("DROP", "vlm_conditions", 0)}
    assert kept - {f for f in Store(spark, target, "day").files()} and len(Store(spark, target, "day").read().collect()) == len(fourth)


def test_audit_states_lie_on_disk(spark, tmp_path):
    """An executor's memory does not hold the objects; the session's own settings stay."""
    from framelake.streaming import audit

    before = {k: spark.conf.get(k, None) for k in audit.ON_DISK}
    put(tmp_path / "in", "1.json", [{"kind": "object", "object_id": f"o{i}", "at": "2024-01-01T00:00:00Z", "day": "d", "feed_label": "car"} for i in range(50)])
    feed = spark.readStream.schema(f"kind string, object_id string, at timestamp, day string, {audit.OBJECT}, {audit.SEGMENT}, {audit.VERDICT}").json(str(tmp_path / "in"))
    out = audit.audit_states(spark, *[feed.where(F.col("kind") == k) for k in audit.PARTS], str(tmp_path / "out"), str(tmp_path / "cp"), "1 day")
    out.awaitTermination()
    (states,) = out.lastProgress["stateOperators"]
    assert states["numRowsUpdated"] > 1 and any(m.startswith("rocksdb") for m in states["customMetrics"])
    assert before == {k: spark.conf.get(k, None) for k in audit.ON_DISK}


def test_late_events_are_kept(spark, tmp_path):
    """Days in any order: an event that is new is kept however old it is, and one without a time too."""
    target = str(tmp_path / "out")
    for number, days in enumerate(((9, 9), (2, 9), (5, None, 2))):
        put(tmp_path / "in", f"{number}.json", [{"id": f"e{d}", "ts": d and f"2024-01-{d:02d}T00:00:00Z"} for d in days])
        stream = spark.readStream.schema("id string, ts timestamp").json(str(tmp_path / "in"))
        incremental.collect_events(spark, stream, target, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == ["e2", "e5", "e9", "eNone"]


def test_one_step_of_the_state_settles_many_objects():
    """Two are decided, one waits and comes by its own time, whether or not its bucket has news by then."""
    import pandas as pd

    class State:
        exists, hasTimedOut, now, due, held = False, False, 1000, None, None

        @property
        def get(self):
            return self.held

        def getCurrentProcessingTimeMs(self):
            return self.now

        def update(self, held):
            self.held, self.exists, self.due = held, True, None

        def setTimeoutDuration(self, ms):
            self.due = self.now + ms

    def news(*rows):
        return iter([pd.DataFrame(rows, columns=["object_id", "kind", "text", "at", "mark"])])

    def run(state, frames):
        return sorted((r[0], r[3], r[5]) for out in settle((7,), frames, state) for r in out.itertuples(index=False, name=None))

    settle, state = audit._settle(500), State()
    first = [(o, "object", "{}", 1, "d") for o in "abc"] + [("a", "segment", "s", 1, None), ("b", "segment", "s", 1, "valid"), ("b", "verdict", "v", 1, None)]
    assert run(state, news(*first)) == [("a", None, 0), ("b", "v", 0)] and state.due == 1500
    state.now = 1400
    assert run(state, news(("d", "object", "{}", 1, "d"))) == [] and state.due == 1500  # c still waits since 1000
    state.now = 1501
    assert run(state, news(("e", "segment", "s", 1, None))) == [("c", None, 1)] and state.due == 1900
    state.now, state.hasTimedOut = 1901, True
    assert run(state, iter([])) == [("d", None, 1)] and state.due is None
