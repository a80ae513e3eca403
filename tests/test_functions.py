import hashlib
import math
import random

import pytest
from framelake.functions import boxes, hashes, labels, times
from pyspark.sql import functions as F


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def lit_box(*v):
    return boxes.box(*[F.lit(float(x)) for x in v])


def test_overlap_measures(spark):
    a, b, far, flat = lit_box(0, 0, 2, 2), lit_box(1, 1, 3, 3), lit_box(5, 5, 6, 6), lit_box(1, 1, 1, 1)
    r = one(spark, iou=boxes.iou(a, b), none=boxes.iou(a, far), zero=boxes.iou(flat, flat), inside=boxes.containment(b, a), nothing=boxes.containment(flat, a), union=boxes.union_area(a, b), d=boxes.edge_deltas(a, b), c=boxes.center(a), ok=boxes.is_valid(flat), moved=boxes.shifted(a, 1, -1))
    assert math.isclose(r["iou"], 1 / 7) and r["none"] == r["zero"] == r["nothing"] == 0 and r["inside"] == 0.25 and r["union"] == 7
    assert tuple(r["d"]) == (1, 1, 1, 1) and tuple(r["c"]) == (1, 1) and r["ok"] is False and tuple(r["moved"]) == (1, -1, 3, 1)


def test_conversions(spark):
    a = F.array(*[F.lit(x) for x in (10.0, 20.0, 30.0, 40.0)])
    b = boxes.from_xywh(a)
    r = one(spark, b=b, c=boxes.from_cxcywh(a), back=boxes.to_xywh(b), cc=boxes.to_cxcywh(b), n=boxes.normalized(b, 100, 100), bad=boxes.normalized(b, 0, 100), px=boxes.scaled(lit_box(0.1, 0.2, 0.3, 0.4), 100, 50), clip=boxes.clip(lit_box(-5, -5, 200, 20), 100, 50), crop=boxes.frame_to_crop(b, 10, 20), short=boxes.from_xywh(F.array(F.lit(1.0))))
    assert tuple(r["b"]) == (10, 20, 40, 60) and tuple(r["c"]) == (-5, 0, 25, 40) and r["back"] == [10, 20, 30, 40] and r["cc"] == [25, 40, 30, 40]
    assert tuple(r["n"]) == (0.1, 0.2, 0.4, 0.6) and r["bad"] is None and tuple(r["px"]) == (10, 10, 30, 20) and tuple(r["clip"]) == (0, 0, 100, 20)
    assert tuple(r["crop"]) == (0, 0, 30, 40) and r["short"] is None


def test_declared_conventions(spark):
    def parse(raw, fmt="xyxy", norm=False, space="image", origin=None, frame=None):
        o = F.struct(F.lit(origin[0] if origin else None).cast("double").alias("x"), F.lit(origin[1] if origin else None).cast("double").alias("y"))
        f = F.struct(F.lit(frame[0] if frame else None).cast("double").alias("w"), F.lit(frame[1] if frame else None).cast("double").alias("h"))
        box, reason = boxes.declared_box(F.array(*[F.lit(x).cast("double") for x in raw]), F.lit(fmt), F.lit(norm), F.lit(space), 100.0, 100.0, o, f)
        r = one(spark, box=box, reason=reason)
        return r["reason"] or tuple(round(x, 6) for x in r["box"])

    assert parse([10, 10, 20, 20]) == (10, 10, 20, 20)
    assert parse([10, 10, 20, 200], "xywh") == (10, 10, 30, 100)
    assert parse([0.5, 0.5, 0.2, 0.2], "cxcywh", True) == (40, 40, 60, 60)
    assert parse([60, 60, 80, 80], space="frame", origin=(50, 50)) == (10, 10, 30, 30)
    assert parse([0.1, 0.1, 0.2, 0.2], norm=True, space="frame", origin=(50, 50), frame=(1000, 1000)) == (50, 50, 100, 100)
    assert parse([60, 60, 80, 80], space="frame") == "no_crop_origin"
    assert parse([0.1, 0.1, 0.2, 0.2], norm=True, space="frame", origin=(5, 5)) == "no_frame_size"
    assert parse([1, 2, 3]) == "bad_bbox" and parse([1, 2, None, 4]) == "bad_bbox" and parse([1, 2, 3, 4], "yxyx") == "unknown_format"
    assert parse([20, 20, 10, 10]) == "empty_box" and parse([200, 200, 300, 300]) == "empty_box"


def test_stored_coco_and_model_boxes(spark):
    s = boxes.stored_box
    r = one(spark, a=s(lit_box(0.1, 0.1, 0.5, 0.5), 100, 100)[1], b=s(lit_box(0.5, 0.1, 0.5, 0.5), 100, 100)[1], c=s(boxes.box(F.lit(None), F.lit(0), F.lit(1), F.lit(1)), 100, 100)[1], d=s(lit_box(1.2, 0.1, 1.5, 0.5), 100, 100)[1])
    assert tuple(r) == (None, "degenerate_box", "missing_box", "outside_image")
    arr = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    r = one(spark, a=boxes.coco_box(arr(50, 50, 100, 10), F.lit(100), F.lit(100)), b=boxes.coco_box(arr(0, 0, 0, 5), F.lit(100), F.lit(100)), m=boxes.clamped_model_box(lit_box(0.5, 0.1, 0.50001, 2)), n=boxes.clamped_model_box(lit_box(0.5, 0.1, 0.5, 1)), sane=boxes.is_sane(lit_box(0, 0, 1, 1)), slack=boxes.is_sane(lit_box(0, 0, 1.0000001, 1), 1e-6), no=boxes.is_sane(lit_box(0, 0, 1.1, 1)))
    assert tuple(r["a"]) == (0.5, 0.5, 1, 0.6) and r["b"] is None and math.isclose(r["m"]["x2"], 0.5001) and r["m"]["y2"] == 1 and r["n"] is None
    assert (r["sane"], r["slack"], r["no"]) == (True, True, False)


def test_masks_equal_pixel_by_pixel(spark):
    rng = random.Random(1)
    runs = [(y, x0 := rng.randint(0, 20), x0 + rng.randint(0, 12)) for y in range(15)]
    df = spark.createDataFrame([([{"y": y, "x0": a, "x1": b} for y, a, b in runs],)], "runs array<struct<y:int,x0:int,x1:int>>")
    pixels = {(x, y) for y, a, b in runs for x in range(a, b)}
    for b in ((2.5, 3.2, 14.0, 9.7), (0, 0, 40, 40), (5, 5, 5, 5)):
        r = df.select(boxes.mask_pixels_in(F.col("runs"), lit_box(*b)).alias("n"), boxes.mask_area(F.col("runs")).alias("a"), boxes.tight_box(F.col("runs")).alias("t"), boxes.object_geometry(lit_box(*b), lit_box(0, 0, 10, 10), F.col("runs")).alias("g")).first()
        assert r["n"] == sum(b[0] <= x < b[2] and b[1] <= y < b[3] for x, y in pixels) and r["a"] == len(pixels) == r["g"]["mask_area"]
        assert tuple(r["t"]) == (min(x for x, _ in pixels), min(y for _, y in pixels), max(x for x, _ in pixels) + 1, max(y for _, y in pixels) + 1)
    none = df.select(F.filter("runs", lambda r: F.lit(False)).alias("runs")).select(boxes.tight_box(F.col("runs")), boxes.mask_containment(F.col("runs"), lit_box(0, 0, 1, 1))).first()
    assert tuple(none) == (None, 0.0)


def test_labels(spark):
    df = spark.createDataFrame([(" People ",), ("SUV",), ("truck",), ("",), (None,)], "x string")
    got = lambda v: [r[0] for r in df.select(labels.canonical_label(F.col("x"), v)).collect()]
    assert got(["person", "car"]) == ["person", "car", "", "", ""] and got(None) == ["people", "suv", "truck", "", ""] and got([]) == [""] * 5
    assert got(["Truck"]) == ["", "", "truck", "", ""]
    assert len(labels.CLASSES_80) == 80
    r = one(spark, a=labels.class_index(F.lit("person")), b=labels.class_index(F.lit("toothbrush")), c=labels.class_index(F.lit("dragon")), n=labels.run_name(F.lit("yolo-n-v2")), m=labels.run_name(F.lit("plain")))
    assert (r["a"], r["b"], r["c"]) == (0, 79, None) and tuple(r["n"]) == ("yolo-n", "v2") and tuple(r["m"]) == ("plain", "")
    table = {x["label"]: x["class_id"] for x in labels.class_table(spark, ["car", "person"], "coco80").collect()}
    assert table == {"car": 2, "person": 0}


def test_json_from_text(spark):
    texts = ['{"a": 1}', 'Sure: {"a": 1} done', '```json\n{"a": 1}\n```', 'x ```\n[1]\n``` then ```json\n{"a": 2}\n```', "[1, 2] tail", "none", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r[0] for r in df.select(labels.json_text(F.col("x"))).collect()] == ['{"a": 1}', '{"a": 1}', '{"a": 1}', '{"a": 2}', "[1, 2]", None, None]
    assert [r[0] is None for r in df.select(F.to_json(labels.tolerant_json(F.col("x")))).collect()][-2:] == [True, True]


def test_times(spark):
    texts = ["1700000000.5", " 5 ", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02T03:04:05", "bad", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(times.unix_seconds(F.col("x"))).collect()]
    assert got == [1700000000.5, 5.0, 1704164645.0, 1704157445.0, 1704164645.0, None, None]
    east = [r[0] for r in df.select(times.unix_seconds(F.col("x"), "+01:00")).collect()]
    assert east[4] == 1704164645.0 - 3600
    r = one(spark, d=times.day_key(F.lit(1704164645.0)), p=times.partition_path(F.lit(1704164645.0), F.lit("cam"), F.lit("s1")))
    assert tuple(r) == ("20240102", "20240102/cam/s1")
    hours = spark.range(24).select(times.time_bucket(F.col("id") * 3600.0))
    assert [x[0] for x in hours.collect()] == ["night"] * 5 + ["dawn"] * 4 + ["day"] * 8 + ["dusk"] * 4 + ["night"] * 3


@pytest.mark.parametrize("start,end,n,gap,want", [(100, 120, 1, 2, [100]), (100, 120, 2, 2, [100, 120]), (100, 200, 5, 10, [100, 125, 150, 175, 200]), (100, 103, 5, 2, [100, 103]), (100, 101, 5, 2, [100]), (100, None, 5, 2, [100]), (100, 90, 5, 2, [100])])
def test_frame_times(spark, start, end, n, gap, want):
    r = one(spark, t=times.frame_times(F.lit(float(start)), F.lit(end).cast("double"), n, gap))
    assert r["t"] == want


def test_hashes(spark):
    rng = random.Random(2)
    grid = [rng.randint(0, 255) for _ in range(72)]
    bits = "".join("1" if grid[r * 9 + c] >= grid[r * 9 + c + 1] else "0" for r in range(8) for c in range(8))
    df = spark.createDataFrame([(grid,)], "g array<int>")
    h = hashes.difference_hash(F.col("g"), 8)
    r = df.select(h.alias("h"), hashes.bits_to_long(h).alias("n"), hashes.hamming(h, F.lit("1")).alias("d"), hashes.hamming_long(hashes.bits_to_long(h), F.lit(0).cast("long")).alias("b")).first()
    assert r["h"] == bits and r["n"] & (2**64 - 1) == int(bits, 2) and r["d"] == bin(int(bits, 2) ^ 1).count("1") and r["b"] == bits.count("1")
    r = one(spark, s=hashes.sample_hash(img=F.lit("a"), bbox=F.lit(None)), c=hashes.content_hash(F.lit(b"xy")))
    assert r["s"] == hashlib.sha256(b"img:a|bbox:").hexdigest() and r["c"] == hashlib.sha256(b"xy").hexdigest()


def test_splits_equal_python(spark):
    def split(i, seed):
        p = int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:8], "big") / 2**64
        return "train" if p < 0.8 else "val" if p < 0.9 else "test"

    ratios = {"train": 0.8, "val": 0.1, "test": 0.1}
    got = spark.range(20_000).select("id", hashes.assign_split(F.col("id"), ratios, "s").alias("x")).collect()
    assert all(r["x"] == split(r["id"], "s") for r in got)
    assert 0.79 < sum(r["x"] == "train" for r in got) / 20_000 < 0.81
    with pytest.raises(ValueError):
        hashes.assign_split(F.col("id"), {"train": 0}, "s")


def test_masks_are_measured_by_arrays(spark):
    """Many masks at once, also null, empty, dead and partly null ones, and no box; a plan has one step for all measures."""
    schema = "n int, runs array<struct<y:int,x0:int,x1:int>>, b struct<x1:double,y1:double,x2:double,y2:double>"
    unit = (0.0, 0.0, 10.0, 10.0)
    data = [(0, None, unit), (1, [], unit), (2, [(1, 5, 5), (2, 7, 3)], unit), (3, [(1, 2, 5), (4, 8, 14), (20, 0, 1)], unit), (4, [(1, 2, 5)], None), (5, [(1, None, 5), (2, 3, 4)], unit)]
    data += [(6 + i, [(y, i % 3, i % 3 + 2) for y in range(i % 5)], unit) for i in range(2000)]
    df = spark.createDataFrame(data, schema).coalesce(1)
    out = df.select("n", boxes.mask_area(F.col("runs")).alias("a"), boxes.mask_pixels_in(F.col("runs"), F.col("b")).alias("p"), boxes.tight_box(F.col("runs")).alias("t"))
    got = {r["n"]: (r["a"], r["p"], r["t"] and tuple(r["t"])) for r in out.collect()}
    assert [got[i] for i in range(5)] == [(None, None, None), (0, 0, None), (0, 0, None), (10, 5, (0, 1, 14, 21)), (3, 0, (2, 1, 5, 2))] and got[5][2] == (3, 2, 4, 3)
    for i in range(2000):
        rows, x = i % 5, i % 3
        assert got[6 + i] == (2 * rows, 2 * rows, (x, 0, x + 2, rows) if rows else None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "aggregate(" not in plan


def test_object_geometry_sql_rounds_as_the_query(spark, tmp_path):
    """Boxes whose agreement is half a millionth: 0.0546875 and 0.2578125."""
    import datetime

    import duckdb
    from framelake.plans import registry

    day = datetime.datetime(2020, 1, 1)
    rows = []
    for part, supp, quantity, line in ((18, 47, 39, 1), (18, 48, 39, 1), (21, 9, 23, 7), (21, 21, 23, 7), (21, 22, 23, 7)):
        rows += [(len(rows) + 1, part, supp, line, float(quantity), 1.0, d / 100, 0.0, "A", "F", day) for d in range(11)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = sorted(c.execute(f"SELECT object_id, iou FROM ({registry.ORACLES['g21_object_geometry']})").fetchall())
    got = sorted((r["object_id"], r["iou"]) for r in registry.QUERIES["g21_object_geometry"](spark, str(tmp_path)).collect())
    assert got == want and {54688, 257813} <= {v for _, v in got}
