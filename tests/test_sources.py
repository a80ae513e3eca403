import json

from framelake.sources import feeds, files
from pyspark.sql import functions as F


def put(path, *objects):
    path.write_text("\n".join(o if isinstance(o, str) else json.dumps(o) for o in objects))
    return str(path)


def test_review_feed(spark, tmp_path):
    path = put(tmp_path / "r.json", {"id": "r1", "camera": "front", "start_time": 100.5, "end_time": 160, "data": {"detections": ["e1", "e2"]}, "zones": ["z"]}, {"id": "r2", "thumb_path": None, "severity": "alert", "start_time": "2024-01-02T03:04:05Z", "data": [1]}, {"id": "r3", "start_time": 50, "data": {"objects": [{"id": "e2"}, {"id": "e3"}, {}]}}, "{broken")
    rows = {r["id"]: r for r in feeds.read_reviews(spark, path).withColumn("data", F.to_json("data")).collect()}
    assert sorted(rows) == ["r1", "r2", "r3"]
    assert (rows["r1"]["severity"], rows["r1"]["start_time"], rows["r1"]["end_time"], rows["r1"]["zones"]) == ("detection", 100.5, 160.0, ["z"])
    assert (rows["r2"]["severity"], rows["r2"]["thumb_path"], rows["r2"]["start_time"], rows["r2"]["data"], rows["r2"]["camera"]) == ("alert", "", 1704164645.0, None, "")
    found = feeds.event_ids(feeds.read_reviews(spark, path)).collect()
    assert {r["event_id"]: r["first"]["review_id"] for r in found} == {"e1": "r1", "e2": "r1", "e3": "r3"}
    assert feeds.rejected(spark, path, "id string, _corrupt_record string").first()["reason"] == "malformed_json"


def test_event_feed(spark, tmp_path):
    path = put(tmp_path / "e.json", {"id": "e1", "camera": "c", "label": "car", "start_time": 1, "end_time": 9, "box": [0.1, 0.2, 0.3, 0.4], "data": {"score": 0.9}, "score": 0.5, "top_score": "x"}, {"id": "e2", "start_time": None, "data": {"box": [0, 0, 1, 1]}, "score": 0.5}, {"id": "e3", "box": [1, 2]})
    rows = {r["id"]: r for r in feeds.read_events(spark, path).collect()}
    assert tuple(round(x, 6) for x in rows["e1"]["box"]) == (0.1, 0.2, 0.4, 0.6) and rows["e1"]["score"] == 0.9 and rows["e1"]["top_score"] is None and rows["e1"]["completed"]
    assert tuple(rows["e2"]["box"]) == (0, 0, 1, 1) and rows["e2"]["score"] == 0.5 and rows["e2"]["start_time"] == 0 and not rows["e2"]["completed"]
    assert rows["e3"]["box"] is None
    frames = feeds.plan_frames(feeds.read_events(spark, path), 3, 2.0).collect()
    assert [(r["frame_index"], r["frame_ts"]) for r in frames] == [(0, None), (1, 5.0), (2, 9.0)]
    assert feeds.plan_frames(feeds.read_events(spark, path), 3, crops=True).count() == 1
    assert {r["id"]: r["outcome"] for r in feeds.refused_events(feeds.read_events(spark, path), crops=True).collect()} == {"e1": "ok", "e2": "failed", "e3": "failed"}


def test_motion_feed(spark, tmp_path):
    path = put(tmp_path / "m.json", {"start_time": 10.9, "motion": 0.5, "camera": "c"}, {"start_time": 11, "camera": "c"}, {"motion": 1}, "[1]", "junk")
    assert sorted(tuple(r) for r in feeds.read_motion(spark, path).collect()) == [("c", 10, 0.5), ("c", 11, 0.0)]


def test_windowed_reviews(spark):
    rows = [("a", "detection", 5.0, "c1", ["z1"]), ("a", "alert", 4.0, "c1", ["z1"]), ("b", "alert", 3.0, "c2", []), ("d", "alert", 2.0, "c1", ["z2"]), ("e", "detection", 1.0, "c1", ["z1"])]
    df = spark.createDataFrame(rows, "id string, severity string, start_time double, camera string, zones array<string>")
    assert sorted((r["id"], r["severity"]) for r in feeds.list_reviews(df, limit=2).collect()) == [("a", "alert"), ("b", "alert"), ("e", "detection")]
    assert sorted(r["id"] for r in feeds.list_reviews(df, after=2, zones=["z2", "z1"], cameras=["c1"]).collect()) == ["a", "d"]


def test_coco_import(spark, tmp_path):
    coco = {"images": [{"id": 1, "file_name": "a.jpg", "width": 100, "height": 100}, {"id": 2, "file_name": "b.jpg"}, {"id": 3, "file_name": "gone.jpg", "width": 10, "height": 10}], "annotations": [{"id": 1, "image_id": 1, "category_id": 7, "bbox": [10, 10, 20, 200]}, {"id": 2, "image_id": 1, "category_id": 8, "bbox": [0, 0, 5, 5], "score": 0}, {"id": 3, "image_id": 2, "category_id": 9, "bbox": [0, 0, 5, 5]}, {"id": 4, "image_id": 3, "category_id": 7, "bbox": [0, 0, 5, 5]}], "categories": [{"id": 7, "name": "human"}, {"id": 8, "name": "car"}, {"id": 9, "name": "tree"}]}
    frame = files.read_coco(spark, put(tmp_path / "c.json", coco))
    present = spark.createDataFrame([("a.jpg",), ("b.jpg",)], "file_name string")
    samples, annotations, summary = files.import_coco(frame, ["person", "car"], {"human": "person"}, present)
    assert [tuple(r) for r in samples.collect()] == [("external-1", "a.jpg", "person", 0)]
    got = {r["id"]: r for r in annotations.collect()}
    assert sorted(got) == ["external-a1", "external-a2"] and (got["external-a1"]["y2"], got["external-a2"]["confidence"]) == (1.0, 1.0)
    assert summary.first().asDict() == {"images": 3, "objects": 4, "skipped_unmapped": 1, "written": 1, "skipped_missing": 1}


def test_audit_manifest(spark, tmp_path):
    manifest = {"image_root": "root", "bbox_format": "xywh", "class_map": {"car": 9}, "objects": [{"id": "o1", "image": "a.jpg", "class_name": "person", "bbox": [10, 10, 20, 20]}, {"id": "o2", "image": "b.jpg", "class_name": "car", "bbox": [0.1, 0.1, 0.5, 0.5], "bbox_format": "xyxy", "normalized": True, "width": 100, "height": 100}, {"id": "o1", "image": "a.jpg", "class_name": "person", "bbox": [1, 1, 2, 2]}, {"image": "a.jpg", "class_name": "x", "bbox": [1, 1, 2, 2]}, {"id": "o5", "image": "a.jpg", "class_name": "x", "bbox": [1, 1]}, {"id": "o6", "class_name": "x", "bbox": [1, 1, 2, 2]}]}
    objects, rejects = files.read_audit_manifest(spark, put(tmp_path / "m.json", manifest))
    got = {r["object_id"]: r for r in objects.collect()}
    assert tuple(got["o1"]["box"]) == (10, 10, 30, 30) and got["o1"]["image_path"] == "root/a.jpg" and (got["o1"]["class_id"], got["o2"]["class_id"]) == (0, 9)
    assert tuple(got["o2"]["box"]) == (10, 10, 50, 50)
    assert sorted(r["reason"] for r in rejects.collect()) == ["bad_bbox", "duplicate_id", "missing_id", "missing_image"]


def test_label_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("0 0.5 0.5 0.2 0.2\n\n1 0.5 0.5 0.2\n")
    (tmp_path / "b.txt").write_text("7 0.5 0.5 0.2 0.2\n1 1.5 0.5 0.2 0.2\nx 0 0 1 1\n1 0.5 0.5 0 0.2\n1 0.1 0.1 0.1 0.1")
    lines = files.read_labels(spark, f"{tmp_path}/*.txt", 2)
    assert sorted((r["file"][-5:], r["line_no"], r["valid"]) for r in lines.collect()) == [("a.txt", 0, True), ("a.txt", 2, False), ("b.txt", 0, False), ("b.txt", 1, False), ("b.txt", 2, False), ("b.txt", 3, False), ("b.txt", 4, True)]
    images = files.list_images(spark, str(tmp_path))
    assert images.count() == 2 and len(images.first()["content_hash"]) == 64
    paths = spark.createDataFrame([(images.first()["path"],), ("none",)], "image_path string")
    assert files.existing(paths, images).count() == 1


def test_manifest_append(spark, tmp_path):
    old = files.read_manifest(spark, put(tmp_path / "m.jsonl", {"sample_id": "a", "labels": ["x"]}))
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,)], "sample_id string")
    good, bad = files.append_manifest(old, new)
    assert [r["sample_id"] for r in good.collect()] == ["b"] and sorted(r["reason"] for r in bad.collect()) == ["duplicate_id"] * 3 + ["missing_id"]
    assert files.append_manifest(old, new, allow_overwrite=True)[1].count() == 1


def test_class_names(spark, tmp_path):
    yaml, text = tmp_path / "d.yaml", tmp_path / "classes.txt"
    yaml.write_text("path: x\nnames:\n  1: car\n  0: 'person'\n")
    text.write_text("person\ncar\n")
    want = [(0, "person"), (1, "car")]
    assert sorted(tuple(r) for r in files.read_class_names(spark, str(yaml)).collect()) == want
    assert sorted(tuple(r) for r in files.read_class_names(spark, str(text)).collect()) == want


def test_decisions_and_provenance(spark, tmp_path):
    for name, body in {"o1": {"decision": {"status": "KEEP"}, "provenance": {"source": {"class_name": "person", "zone": "z"}}}, "o2": {"decision": {"status": "DROP", "reason": "sam_failure", "feed_label": "car"}}, "o3": "[1]", "o4": "{bad"}.items():
        (tmp_path / name).mkdir()
        put(tmp_path / name / "decision.json", body)
    rows = {r["object_id"]: r for r in files.read_decisions(spark, f"{tmp_path}/*/decision.json").collect()}
    assert sorted(rows) == ["o1", "o2"] and rows["o1"]["feed_label"] == "person" and rows["o1"]["extra"] == {"zone": "z"} and rows["o2"]["feed_label"] == "car"
    path = put(tmp_path / "p.jsonl", {"sample_id": "a", "n": 1}, {"sample_id": "x", "source": {"sample_id": "a"}, "n": 2}, {"sample_id": "y", "source": {"sample_id": "b"}, "n": 3}, {"sample_id": "z", "source": {"sample_id": "b"}, "n": 4}, "junk")
    got = {r["key"]: json.loads(r["record"])["n"] for r in files.read_provenance(spark, path).collect()}
    assert got == {"a": 1, "x": 2, "y": 3, "z": 4, "b": 3}


def test_curves_and_benchmarks(spark, tmp_path):
    (tmp_path / "c.csv").write_text("epoch, map50\n1,0.5\n2,nan\n3,\n4,inf\n")
    assert [r["map50"] for r in files.read_curve(spark, str(tmp_path / "c.csv")).orderBy("epoch").collect()] == [0.5, None, None, None]
    df = spark.createDataFrame([("m", 0.5, 33.0), ("n", None, None)], "name string, map50 double, cpu_percent double")
    files.write_benchmark(df, str(tmp_path / "b"))
    back = files.read_benchmark(spark, str(tmp_path / "b")).select("name", "map50", "cpu_percent")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_dataset_versions_and_exports(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException

    rows = spark.createDataFrame([("a", "train"), ("b", "val")], "sample_id string, split string")
    files.write_dataset(rows, rows.limit(1), str(tmp_path / "v1"))
    with pytest.raises(AnalysisException):
        files.write_dataset(rows, rows.limit(1), str(tmp_path / "v1"))
    names = spark.createDataFrame([("car", 1), ("person", 0)], "label string, class_id int")
    files.write_dataset(rows, rows.limit(1), str(tmp_path / "v1"), overwrite=True, classes=names)
    assert [r["label"] for r in spark.read.json(str(tmp_path / "v1" / "classes")).collect()] == ["person", "car"]
    many = spark.createDataFrame([(f"{i:03d}", "train" if i % 3 else "val") for i in range(90, -1, -1)], "sample_id string, split string")
    files.write_dataset(many, many.limit(1), str(tmp_path / "v2"))
    for split in ("train", "val"):
        parts = sorted((tmp_path / "v2" / "lists" / f"split={split}").glob("part-*"))
        assert [x for p in parts for x in p.read_text().split()] == sorted(r["sample_id"] for r in many.where(F.col("split") == split).collect())
    objects = spark.createDataFrame([("o1", "f1", "0 b"), ("o2", "f1", "0 a"), ("o3", "f2", "0 c")], "object_id string, frame_key string, label_line string")
    bodies, lines = files.export_new(objects, objects.where("object_id = 'o3'"))
    assert [tuple(r) for r in bodies.collect()] == [("f1", "0 a\n0 b")] and lines.count() == 2
    assert files.export_new(objects, objects)[0].count() == 0


def test_lines_of_a_file_read_in_parts(spark, tmp_path):
    """One file over many tasks: the same numbers and records as line by line, blank and very long lines too."""
    rows = [json.dumps({"sample_id": f"s{i % 700}", "source": {"sample_id": f"t{i % 50}"}, "n": i, "pad": "x" * (i % 300)}) for i in range(3000)]
    rows[7] = rows[8] = ""
    rows[20] = "{broken"
    rows[1500] = json.dumps({"sample_id": "long", "n": 1500, "pad": "y" * 200_000})
    (tmp_path / "a.jsonl").write_text("\n".join(rows) + "\n")
    (tmp_path / "b.jsonl").write_text("one\n\ntwo")
    (tmp_path / "c.jsonl").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(str(tmp_path / "a.jsonl")).rdd.getNumPartitions() > 20
        lines = files.numbered_lines(spark, str(tmp_path)).collect()
        got = {(r["file"][-7:], r["line_no"]): r["value"] for r in lines}
        assert len(got) == len(lines) and got == {("a.jsonl", i): v for i, v in enumerate(rows)} | {("b.jsonl", i): v for i, v in enumerate(["one", "", "two"])}
        kept = {r["key"]: json.loads(r["record"])["n"] for r in files.read_provenance(spark, str(tmp_path / "a.jsonl")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {}
    for key in ("s", "t"):
        for v in rows:
            if v and v != "{broken":
                r = json.loads(v)
                name = r["sample_id"] if key == "s" else r.get("source", {}).get("sample_id")
                if name:
                    want.setdefault(name, r["n"])
    assert kept == want


def test_benchmark_lines_are_one_object(spark, tmp_path):
    rows = [(f"m{i:03d}", "v1", i / 100, None) for i in range(150)] + [("m000", "v1", 0.0, None)]
    for n in (151, 1, 0):
        df = spark.createDataFrame(rows[:n], "name string, version string, map50 double, recall double").repartition(3)
        files.write_benchmark(df, str(tmp_path / f"out{n}"))
        whole = "".join(p.read_text() for p in sorted((tmp_path / f"out{n}").glob("part-*")))
        assert sorted(r["name"] for r in json.loads(whole)["results"]) == sorted(r[0] for r in rows[:n])
        assert sorted(r["name"] for r in files.read_benchmark(spark, str(tmp_path / f"out{n}")).collect()) == sorted(r[0] for r in rows[:n])
        (tmp_path / f"whole{n}.json").write_text(whole)
        assert files.read_benchmark(spark, str(tmp_path / f"whole{n}.json"), lines=False).count() == n


def test_manifests_are_taken_apart_once(spark):
    """Good objects and rejects read one written table: no part of the result explodes the manifests again."""
    from framelake import schemas

    text = '{"image_root": "/r", "bbox_format": "xyxy", "class_map": {"car": 7}, "objects": [{"id": "a", "image": "i", "class_name": "car", "bbox": [1, 1, 5, 5]}, {"id": "b", "image": "i", "class_name": "dog", "bbox": [1, 1, 5, 5]}, {"id": "c", "image": "i"}]}'
    raw = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", schemas.AUDIT_MANIFEST).alias("m")).select("m.*")
    good, bad = files.parse_audit_manifest(raw, 200, 100)
    assert {(r["object_id"], r["image_path"], r["class_id"]) for r in good.collect()} == {("a", "/r/i", 7), ("b", "/r/i", 1)}
    assert [tuple(r) for r in bad.collect()] == [("c", 2, "missing_class")]
    for part in (good, bad):
        assert "Generate" not in part._jdf.queryExecution().executedPlan().toString()
