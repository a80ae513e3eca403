import random

import pytest
from framelake.functions import boxes
from framelake.operators import datasets, dedup, evaluate, ledger, matching, nearhash, pool, ranges, reconcile, scoring, sessions, skyline
from pyspark.sql import functions as F

SAMPLES = "id string, camera string, ts double, event_id string, frame_index int, image_path string, image_hash string, status string, quality string, verified int, feed_label string, created_at string"
ANNOTATIONS = "id string, sample_id string, event_id string, source string, label string, x1 double, y1 double, x2 double, y2 double, confidence double, verified int, created_at string"


@pytest.fixture(scope="module")
def samples(spark):
    rows = [
        ("s1", "front", 300.0, "e1", 0, "p1", "h1", "collected", "useful", 1, "person", "2024-01-03"),
        ("s2", "front", 200.0, "e2", 0, "p2", "h1", "collected", None, 0, "car", "2024-01-02"),
        ("s3", "back", 100.0, "e3", 0, "p3", "h1", "imported", "bad", 0, None, "2024-01-01"),
        ("s4", "back", 50.0, "e4", 0, "p4", None, "collected", "duplicate", 0, "dog", "2024-01-01"),
    ]
    return spark.createDataFrame(rows, SAMPLES)


@pytest.fixture(scope="module")
def annotations(spark):
    rows = [
        ("a1", "s1", "e1", "vlm", "person", 0.1, 0.1, 0.5, 0.5, 0.95, 1, "2"),
        ("a2", "s1", "e1", "feed", "person", 0.1, 0.1, 0.5, 0.52, 0.8, 0, "1"),
        ("a3", "s1", "e1", "feed", "car", 0.1, 0.1, 0.5, 0.52, 0.8, 0, "1"),
        ("a4", "s2", "e2", "human", "car", 0.2, 0.2, 0.6, 0.6, 0.8, 1, "1"),
        ("a5", "s2", "e9", "feed", "car", None, 0.2, 0.6, 0.6, 0.8, 0, "1"),
    ]
    return spark.createDataFrame(rows, ANNOTATIONS)


def ids(df, column="id"):
    return [r[column] for r in df.collect()]


def test_quality_counts(samples, annotations):
    r = pool.quality_counts(samples, annotations).first().asDict()
    assert r == {"total": 4, "verified": 1, "unverified": 3, "useful": 1, "bad": 1, "duplicate": 1, "ignore": 0, "problematic": 2, "verified_samples": 2, "verified_boxes": 2}
    assert pool.overview(samples, annotations).first()["cameras"] == ["back", "front"]


def test_filters_and_pages(samples, annotations):
    assert ids(pool.search(samples, annotations, label="car").orderBy("id")) == ["s1", "s2"]
    assert ids(pool.verify_candidates(samples, annotations)) == ["s4", "s2"]  # unjudged ones stay, bad ones go
    assert ids(pool.build_selection(samples, annotations).orderBy("id")) == ["s1", "s2"]
    assert ids(pool.page(samples, 1, 1)) == ["s2"] and pool.page(samples, 0, -5).count() == 1 and pool.page(samples, 999).first()["total"] == 4
    assert ids(pool.page_after(samples, 200.0, "s2", 1)) == ["s3"]
    view = {r["id"]: r for r in pool.sample_view(samples, annotations).collect()}
    assert [a["id"] for a in view["s1"]["annotations"]] == ["a2", "a3", "a1"] and view["s4"]["annotations"] == [] and view["s2"]["annotations"][1]["box"] is None
    groups = pool.report_groups(samples).orderBy("camera").collect()
    assert [(g["camera"], g["frames"], g["camera_frames"]) for g in groups] == [("back", ["s4", "s3"], 2), ("front", ["s2", "s1"], 2)]
    reasons = {r["id"]: r["skip_reason"] for r in pool.pool_objects(annotations, samples, "feed", 100, 100).collect()}
    assert reasons == {"a2": None, "a3": None, "a5": "missing_box"}


def test_motion_windows(spark):
    motion = spark.createDataFrame([("front", 100, 0.5), ("front", 110, 0.9), ("front", 300, 0.4), ("deck", 120, 0.3), ("deck", 130, 0.1), ("exact", 0, 1.0), ("exact", 61, 1.0), ("exact", 123, 1.0)], "camera string, start_time long, motion double")
    got = sorted(tuple(r) for r in sessions.motion_windows(motion, 0.3, 60).collect())
    assert got == [("deck", 120, 121, 0.3, 1), ("exact", 0, 62, 1.0, 2), ("exact", 123, 124, 1.0, 1), ("front", 100, 111, 0.9, 2), ("front", 300, 301, 0.4, 1)]
    seen = spark.createDataFrame([("front", 105.0), ("deck", 121.5), ("front", 301.0)], "camera string, ts double")
    marked = sessions.mark_covered(sessions.motion_windows(motion, 0.3, None), seen, 7.0)
    assert {(r["camera"], r["start"]): r["covered"] for r in marked.collect() if r["camera"] != "exact"} == {("front", 100): True, ("front", 300): True, ("deck", 120): False}
    stored = sessions.store_windows(marked.limit(0), marked.union(marked))
    assert stored.count() == 5 and sessions.store_windows(stored, marked).count() == 0


def test_failure_streak(spark):
    rows = [("r", i, f) for i, f in enumerate([1, 0, 1, 1, 0, 1, 1, 1, 0, 1])] + [("q", i, 1) for i in range(2)]
    df = spark.createDataFrame(rows, "run string, n int, failed int")
    got = sessions.until_failure_streak(df, "run", ["n"], "failed", 3)
    assert sorted((r["run"], r["n"]) for r in got.collect()) == [("q", 0), ("q", 1)] + [("r", i) for i in range(8)]
    rng = random.Random(4)
    rows = [(f"r{k}", i, int(rng.random() < k / 12)) for k in range(12) for i in range(90)]
    want = set()
    for k in range(12):
        bad = 0
        for run, i, f in [r for r in rows if r[0] == f"r{k}"]:
            want.add((run, i))
            bad = bad + 1 if f else 0
            if bad == 4:
                break
    df = spark.createDataFrame(rows, "run string, n int, failed int")
    for size in (1, 2, 3, 7, 200):
        got = sessions.until_failure_streak(df, "run", ["n"], "failed", 4, F.floor(F.col("n") / size))
        assert {(r["run"], r["n"]) for r in got.collect()} == want and got.columns == df.columns


def greedy(frames, near):
    kept = []
    for f in frames:
        if not any(near(f, k) for k in kept):
            kept.append(f)
    return {f[0] for f in kept}


def test_near_pairs_and_suppression_equal_greedy(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(63) for _ in range(12)]
    frames = []
    for i in range(240):
        h = base[i % 12]
        for _ in range(rng.randint(0, 9)):
            h ^= 1 << rng.randrange(63)
        frames.append((f"f{i:03d}", f"c{i % 2}", h, float(rng.randint(0, 50)), f"e{i}", 0))
    df = spark.createDataFrame(frames, "id string, camera string, hash long, ts double, event_id string, frame_index int")
    for threshold in (3, 10):
        near = lambda a, b: a[1] == b[1] and (a[2] ^ b[2]).bit_count() <= threshold  # noqa: B023, E731
        want = {(a[1], min(a[2], b[2]), max(a[2], b[2])) for a in frames for b in frames if a[2] != b[2] and near(a, b)}
        got = [(r["camera"], r["a"], r["b"]) for r in nearhash.near_pairs(nearhash.star_cover(dedup.hash_classes(df), threshold, tile=50), threshold, tile=50).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    order = sorted(frames, key=lambda f: (f[3], f[4], f[5], f[0]))
    for parts in (2, 5):
        kept = dedup.suppress_duplicates(df.repartition(parts), threshold)
        assert kept.columns == [*df.columns, "kept"] and {r["id"] for r in kept.where("kept").collect()} == greedy(order, near)


FRAMES = "id string, camera string, hash long, ts double, event_id string, frame_index int"


def test_equal_frames_are_one_class(spark):
    df = spark.createDataFrame([(f"f{i}", "c", 7, float(i), "e", 0) for i in range(2000)] + [("g", "c", 6, 5000.0, "e", 0), ("h", "c", None, 1.0, "e", 0)], FRAMES)
    classes = dedup.hash_classes(df)
    assert sorted((r["hash"], r["n"]) for r in classes.collect()) == [(6, 1), (7, 2000)] and nearhash.near_pairs(nearhash.star_cover(classes)).count() == 1
    assert {r["id"] for r in dedup.suppress_duplicates(df).where("kept").collect()} == {"f0", "h"}
    assert nearhash.near_hashes(df.where("id = 'g'"), df, 0).count() == 1


def test_chain_keeps_both_ends(spark):
    df = spark.createDataFrame([("a", "c", 0b000, 1.0, "e", 0), ("b", "c", 0b001, 2.0, "e", 0), ("c", "c", 0b011, 3.0, "e", 0)], FRAMES)
    assert {r["id"]: r["kept"] for r in dedup.suppress_duplicates(df, 1).collect()} == {"a": True, "b": False, "c": True}


def test_frontier_equals_every_pair_compared(spark):
    rng = random.Random(9)
    rows = [(f"m{rng.randint(0, 40)}", rng.randint(0, 6) / 6, rng.randint(0, 6) / 6, rng.choice([None, 0.0, 1.0, 2.0, 3.0])) for _ in range(120)] + [("n", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "name string, map50 double, recall double, latency_ms double")
    slow = lambda r: r[3] or float("inf")

    def beats(b, a):
        if None in (a[1], b[1]) or a[0] == b[0]:
            return False
        return b[1] >= a[1] and b[2] >= a[2] and slow(b) <= slow(a) and (b[1] > a[1] or b[2] > a[2] or slow(b) < slow(a))

    want = [r for r in rows if not any(beats(b, r) for b in rows)]
    for parts in (1, 6):
        got = evaluate.pareto_frontier(df.repartition(parts))
        assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert "NestedLoop" not in evaluate.pareto_frontier(df)._jdf.queryExecution().toString()
    front = {r[0] for r in want}
    for block in (1, 100_000):
        for r in evaluate.dominators(df, block).collect():
            row = (r["name"], r["map50"], r["recall"], r["latency_ms"])
            assert r["dominated_by"] == sorted({b[0] for b in want if beats(b, row)}) and set(r["dominated_by"]) <= front


def test_overlaps_equal_greedy(spark, annotations):
    assert sorted(ids(dedup.without_overlaps(annotations))) == ["a1", "a3", "a4", "a5"]
    rng = random.Random(5)
    rows = []
    for i in range(300):
        x, y = rng.random() * 0.5, rng.random() * 0.5
        rows.append((f"a{i:03d}", f"s{i % 20}", None, rng.choice(["vlm", "human", "external", "feed", "odd"]), rng.choice("pq"), x, y, x + 0.3, y + 0.3, 0.5, rng.randint(0, 1), str(rng.randint(0, 3))))

    def iou(a, b):
        w, h = min(a[7], b[7]) - max(a[5], b[5]), min(a[8], b[8]) - max(a[6], b[6])
        return 0 if w <= 0 or h <= 0 else w * h / (2 * 0.09 - w * h)

    want, kept = set(), {}
    for r in sorted(rows, key=lambda r: (-r[10], dedup.SOURCE_RANK.get(r[3], 10), r[11], r[0])):
        own = kept.setdefault((r[1], r[4]), [])
        if all(iou(r, k) <= 0.5 for k in own):
            own.append(r)
            want.add(r[0])
    assert set(ids(dedup.without_overlaps(spark.createDataFrame(rows, ANNOTATIONS)))) == want


def test_events_in_and_out(spark, samples, annotations):
    events = spark.createDataFrame([("e1", 1.0), ("e9", 1.0), ("e10", 2.0), ("e11", 1.0)], "id string, start_time double")
    assert ids(dedup.without_known_events(events, samples, annotations, most=1)) == ["e11"]
    assert {r["id"]: r["first_id"] for r in dedup.exact_duplicates(samples).collect()} == {"s1": "s2", "s2": "s2", "s3": "s3", "s4": "s4"}
    gone_s, gone_a = ledger.delete_events(samples, annotations, spark.createDataFrame([("e2",)], "event_id string"))
    assert sorted(ids(gone_s)) == ["s1", "s2", "s3", "s4"] and sorted(ids(gone_a)) == ["a1", "a2", "a3", "a5"]
    gone_s, _ = ledger.delete_events(samples, annotations, spark.createDataFrame([("e2",), ("e9",)], "event_id string"))
    assert sorted(ids(gone_s)) == ["s1", "s3", "s4"]


def plain_match(preds, truths, threshold):
    taken, out = set(), {}
    for p in sorted(preds, key=lambda p: (-p[1], p[0])):
        best = None
        for t in sorted(truths):
            a, b = p[2], t[1]
            w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
            inter = max(w, 0) * max(h, 0)
            union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
            v = inter / union if union > 0 else 0
            if t[0] not in taken and v > threshold and (best is None or v > best[0]):
                best = (v, t[0])
        out[p[0]] = best and best[1]
        if best:
            taken.add(best[1])
    return out


PRED = "candidate string, image_id string, label string, prediction_id string, confidence double, x1 double, y1 double, x2 double, y2 double"
TRUTH = "candidate string, image_id string, label string, truth_id string, x1 double, y1 double, x2 double, y2 double"


def test_matching_equals_plain_matcher(spark):
    rng = random.Random(7)
    preds, truths = {}, {}
    for i in range(400):
        x, y = rng.randint(0, 6) / 10, rng.randint(0, 6) / 10
        preds.setdefault((f"i{i % 30}", "pq"[i % 2]), []).append((f"p{i:03d}", rng.randint(0, 4) / 4, (x, y, x + 0.3, y + 0.4)))
    for i in range(250):
        x, y = rng.randint(0, 6) / 10, rng.randint(0, 6) / 10
        truths.setdefault((f"i{i % 35}", "pq"[i % 2]), []).append((f"t{i:03d}", (x, y, x + 0.35, y + 0.4)))
    p = spark.createDataFrame([("c", im, la, r[0], r[1], *r[2]) for (im, la), rows in preds.items() for r in rows], PRED)
    t = spark.createDataFrame([("c", im, la, r[0], *r[1]) for (im, la), rows in truths.items() for r in rows], TRUTH)
    got = evaluate.match(p, t, (0.5, 0.7))
    for threshold in (0.5, 0.7):
        want = {}
        for key, rows in preds.items():
            want |= plain_match(rows, truths.get(key, []), threshold)
        assert {r["prediction_id"]: r["truth_id"] for r in got.where(F.col("threshold") == threshold).collect()} == want
    pooled = {r["prediction_id"]: r["truth_id"] for r in evaluate.match(p, t, (0.5,), scope="pooled").collect()}
    want = {}
    for label in "pq":
        want |= plain_match([r for k, v in preds.items() if k[1] == label for r in v], [r for k, v in truths.items() if k[1] == label for r in v], 0.5)
    assert pooled == want
    for base in ("matched", "truths"):
        ap = {(r["label"], r["threshold"]): r["ap"] for r in evaluate.average_precision(got, t, recall_base=base).collect()}
        for label in "pq":
            rows = sorted([r for r in got.where("threshold = 0.5").collect() if r["label"] == label], key=lambda r: (-r["confidence"], r["prediction_id"]))
            tp, curve = 0, []
            total = sum(r["truth_id"] is not None for r in rows) if base == "matched" else sum(len(v) for k, v in truths.items() if k[1] == label)
            for k, r in enumerate(rows, 1):
                tp += r["truth_id"] is not None
                curve.append((tp / total, tp / k))
            want = sum(max([pr for re, pr in curve if re >= i / 100 - 1e-12], default=0) for i in range(101)) / 101
            assert abs(ap[(label, 0.5)] - want) < 1e-9


def test_metrics_of_simple_cases(spark):
    box = (0.1, 0.1, 0.5, 0.5)
    t = spark.createDataFrame([("c", "i", "person", "t1", *box), ("c", "i", "car", "t2", 0.6, 0.6, 0.62, 0.62)], TRUTH)
    p = spark.createDataFrame([("c", "i", "person", "p1", 0.9, *box), ("c", "i", "dog", "p2", 0.9, *box)], PRED)
    r = evaluate.evaluate(p, t).first()
    assert (r["tp"], r["fp"], r["n_truths"], r["precision"], r["recall"], r["map50"]) == (1, 0, 2, 1.0, 0.5, 0.5)
    assert (r["small_truths"], r["small_found"], r["fp_rate"]) == (1, 0, 0.0)


def test_pareto_gate_and_latest(spark):
    schema = "name string, map50 double, recall double, fp_rate double, latency_ms double, cpu_percent double"
    c = spark.createDataFrame([("base", 0.5, 0.6, 0.1, 5.0, None), ("good", 0.62, 0.65, 0.1, 3.2, 50.0), ("slow", 0.9, 0.9, 0.1, 30.0, None), ("zero", 0.5, 0.6, 0.3, 0.0, None), ("worse", 0.4, 0.5, 0.1, None, 99.0)], schema)
    assert ids(evaluate.pareto_frontier(c), "name") == ["slow", "good"]
    assert {r["name"]: r["dominated_by"] for r in evaluate.dominators(c).collect()}["base"] == ["good"]
    g = {r["name"]: r for r in evaluate.gate(c, "base").collect()}
    assert {k: v["passed"] for k, v in g.items()} == {"base": True, "good": True, "slow": False, "zero": False, "worse": False}
    checks = lambda n: [(r["check"], r["passed"]) for r in g[n]["reasons"]]
    assert checks("good") == [("latency_ms", True), ("cpu_percent", True), ("recall_delta", True), ("map50_delta", True), ("fp_rate_delta", True)]
    assert checks("base") == [("latency_ms", True)] and g["worse"]["reasons"][0]["value"] is None and ("cpu_percent", False) in checks("worse")
    assert abs(g["good"]["reasons"][2]["value"] - 0.05) < 1e-9 and g["good"]["reasons"][2]["bound"] == -0.02
    rows = ledger.deployment_rows(evaluate.gate(c, "base"), "v1", "2024")
    assert rows.where("verdict = 'PASS'").count() == 2
    d = spark.createDataFrame([("1", "m", "2024-01"), ("2", "m", "2024-02"), ("3", "n", "2024-01")], "id string, model_name string, created_at string")
    assert sorted(ids(evaluate.latest_deployment(d))) == ["2", "3"] and ids(evaluate.latest_deployment(d, False)) == ["2"]
    lat = spark.createDataFrame([("c", 100.0, True), ("c", 4.0, False), ("c", 6.0, False)], "candidate string, latency_ms double, warmup boolean")
    assert tuple(evaluate.latency_summary(lat).first()) == ("c", 5.0, 200.0)


def decide(spark, seg="person", area=10, covers=True, vlm="person", error=None, vocabulary=("person", "car"), gates=reconcile.Gates(), iou=0.5):
    o = spark.createDataFrame([("o", "person")], "object_id string, feed_label string")
    s = spark.createDataFrame([("o", seg, area)], "object_id string, seg_class string, seg_area int").withColumn("seg_box", boxes.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1)))
    s = s.withColumn("g", F.struct(F.lit(10).alias("mask_area"), F.lit(iou).alias("bbox_iou"), F.lit(0.5).alias("mask_bbox_ratio"), F.lit(0.5).alias("mask_feed_containment")))
    v = spark.createDataFrame([("o", covers, vlm, error)], "object_id string, covers boolean, vlm_label string, vlm_error string")
    r = reconcile.decide(o, s, v, list(vocabulary) if vocabulary is not None else None, gates, "g").first()
    return r["status"], r["reason"], r["failing_conditions"], r["training_label"]


def test_decision_table(spark):
    assert decide(spark) == ("KEEP", None, [], "person")
    assert decide(spark, seg=None) == ("DROP", "sam_failure", [], None) and decide(spark, area=0)[1] == "sam_failure"
    assert decide(spark, covers=None, vlm=None, error="transport") == ("PENDING", "vlm_failure", [], None)
    assert decide(spark, covers=None, vlm=None, error="malformed")[:2] == ("DROP", "vlm_malformed") and decide(spark, covers=None, vlm=None)[:2] == ("DROP", "vlm_failure")
    assert decide(spark, vlm=" ") == ("DROP", "vlm_conditions", ["object_present"], None)
    assert decide(spark, covers=False, vlm="car") == ("DROP", "vlm_conditions", ["bbox_covers", "class_mismatch"], None)
    assert decide(spark, vlm="Pedestrian")[0] == "KEEP" and decide(spark, vlm="dragon", seg="dragon")[2] == ["class_mismatch"]
    assert decide(spark, vocabulary=())[2] == ["class_mismatch"] and decide(spark, vocabulary=None, vlm="PERSON")[0] == "KEEP"
    gates = reconcile.Gates(min_bbox_iou=0.6, mask_bbox_ratio_max=0.4)
    assert decide(spark, gates=gates) == ("DROP", "sam_geometry", ["geometry:bbox_iou", "geometry:mask_bbox_ratio_max"], None)
    assert decide(spark, gates=gates, covers=False)[1] == "vlm_conditions"


def test_resume_and_staleness(spark):
    keys = "object_id string, sample_hash string, sam_key string, vlm_key string, pipeline_version string"
    o = spark.createDataFrame([(i, "h", "s", "v", "1") for i in "abcdefg"], keys)
    rows = [("a", "h", "s", "v", "1", "KEEP", None, None, None, True, True), ("b", "h", "s", "v", "1", "PENDING", "vlm_failure", None, None, True, True), ("c", "x", "s", "v", "1", "KEEP", None, None, None, True, True), ("d", "h", "s", "v", "1", "DROP", "sam_failure", "import", "sam", None, None), ("e", "h", "s", "v", "1", "DROP", "sam_failure", "run", "sam", None, None), ("f", "h", "s", "v", "1", "DROP", "vlm_conditions", None, None, False, False)]
    cached = spark.createDataFrame(rows, keys + ", status string, reason string, error_kind string, vlm_error string, has_covers boolean, has_class_label boolean")
    assert sorted(ids(reconcile.unresolved(o, cached), "object_id")) == ["b", "c", "d", "f", "g"]
    assert sorted(ids(reconcile.unresolved(o, cached, teacher_available=False), "object_id")) == ["b", "c", "f", "g"]


def test_background_boxes(spark):
    o = spark.createDataFrame([(f"o{i}", 0.3, 0.3, 0.6, 0.6) for i in range(50)], "object_id string, x1 double, y1 double, x2 double, y2 double")
    out = reconcile.background_boxes(o, 3).select("object_id", "n", boxes.iou(F.col("box"), boxes.box("x1", "y1", "x2", "y2")).alias("v"), boxes.is_sane(F.col("box"), 1e-9).alias("ok"), F.col("box.x1").alias("x")).collect()
    assert len(out) >= 140 and all(r["v"] <= 0.2 and r["ok"] for r in out) and len({r["x"] for r in out}) > 100


def test_background_boxes_draw_only_until_one_is_free(spark):
    """The same boxes as from all draws: objects of a draw's size take some, null edges take none or all as before."""
    rows = [(f"o{i}", x, y, x + 0.5, y + 0.5) for i in range(60) for x, y in [((i % 6) / 10, (i % 5) / 10)]] + [("p", None, 0.1, 0.2, 0.2)]
    o = spark.createDataFrame(rows, "object_id string, x1 double, y1 double, x2 double, y2 double")
    own = boxes.box("x1", "y1", "x2", "y2")
    for most, tries in ((0.2, 16), (0.05, 4), (0.05, 1)):
        out = reconcile.background_boxes(o, 3, 0.5, tries, most)
        draw = lambda a, axis: F.shiftrightunsigned(F.xxhash64("object_id", "n", a, F.lit(axis)), 11).cast("double") / float(2**53) * 0.5
        every = F.transform(F.sequence(F.lit(0), F.lit(tries - 1)), lambda a: boxes.box(draw(a, 0), draw(a, 1), draw(a, 0) + 0.5, draw(a, 1) + 0.5))  # noqa: B023
        plain = o.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn("box", F.get(F.filter(every, lambda b: boxes.iou(b, own) <= most), F.lit(0))).where("box is not null")  # noqa: B023
        assert out.columns == plain.columns and sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "filter(" not in plan and plan.count("_first") > 0


def test_build(spark, samples, annotations):
    classes = spark.createDataFrame([("person", 0), ("car", 1)], "label string, class_id int")
    out = {r["sample_id"]: r for r in datasets.build_outcomes(samples, annotations, classes, max_per_class=1).collect()}
    assert {k: v["outcome"] for k, v in out.items()} == {"s1": "written", "s2": "written"}
    assert out["s1"]["body"] == "0 0.300000 0.300000 0.400000 0.400000" and out["s1"]["labels"] == ["person"] and out["s2"]["labels"] == ["car"]  # front s2 at 200 takes the one car
    images = spark.createDataFrame([("p1",)], "image_path string")
    both = datasets.build_outcomes(samples, annotations, classes.where("label = 'person'"), images)
    assert {r["sample_id"]: r["outcome"] for r in both.collect()} == {"s1": "written", "s2": "class"}
    s = datasets.build_summary(both).first()
    assert (s["total"], s["written"], s["skipped_class"], sum(s["split_counts"].values())) == (2, 1, 1, 1)


def test_golden(spark):
    rows = spark.createDataFrame([("a", "a.jpg"), ("a", "a.jpg"), (None, "b.jpg"), ("c", "c.jpg")], "sample_id string, image string")
    images, marks = spark.createDataFrame([("a.jpg",)], "image string"), spark.createDataFrame([("a",)], "sample_id string")
    got = sorted(map(str, (tuple(r) for r in datasets.validate_golden(rows, images, marks).collect())))
    assert got == sorted(map(str, [(None, "missing_id"), ("a", "duplicate_id"), ("c", "missing_image"), ("c", "missing_label")]))
    new = spark.createDataFrame([("a", "x.jpg", 0.0, None), ("d", "x.gif", 0.0, None), ("e", "x.PNG", 36000.0, None)], "sample_id string, image string, timestamp double, time_bucket string")
    good, bad = datasets.append_golden(rows, new)
    assert [(r["sample_id"], r["time_bucket"]) for r in good.collect()] == [("e", "day")] and {r["sample_id"]: r["reason"] for r in bad.collect()} == {"a": "duplicate_id", "d": "image_type"}


def test_ledgers(spark, samples, annotations):
    some = spark.createDataFrame([("s2",), ("s3",)], "id string")
    out, n = ledger.set_quality(samples, some, "bad")
    assert {r["id"]: r["quality"] for r in out.collect()} == {"s1": "useful", "s2": "bad", "s3": "bad", "s4": "duplicate"} and n.first()[0] == 1
    assert ledger.set_quality(samples, some, None)[0].where("quality is null").count() == 2
    with pytest.raises(ValueError):
        ledger.set_quality(samples, some, "odd")
    item = "array<struct<label:string,confidence:double,x1:double,y1:double,x2:double,y2:double>>"
    results = spark.createDataFrame([("s1", "ok", [("person", 0.9, 0.1, 0.1, 0.2, 0.2), ("ghost", 0.9, 0.1, 0.1, 0.2, 0.2)]), ("s2", "ok", []), ("s3", "rejected", None), ("s4", "transport", None)], f"sample_id string, status string, objects {item}")
    ok = results.where("status = 'ok'")
    s, a = ledger.store_verified(samples, annotations, ok, ["person"])
    assert {r["id"]: r["verified"] for r in s.collect()} == {"s1": 1, "s2": 1, "s3": 0, "s4": 0} and a.count() == 6
    assert ledger.store_verified(samples, annotations, ok, ["person"], mode="replace")[1].count() == 5
    assert ledger.drop_rejected(samples, results).where("quality = 'bad'").count() == 1
    assert tuple(ledger.verify_summary(results).first()) == (4, 1, 1, 1, 1, 2)
    old = spark.createDataFrame([("o1", "KEEP", "1")], "object_id string, status string, updated_at string")
    new, bad = ledger.upsert_overrides(old, spark.createDataFrame([("o1", "DROP", "2"), ("o2", "MAYBE", "2"), ("", "KEEP", "2")], old.schema))
    assert [tuple(r) for r in new.collect()] == [("o1", "DROP", "2")] and sorted(r["reason"] for r in bad.collect()) == ["bad_status", "missing_id"]
    assert ledger.remove_overrides(new, old).count() == 0
    assert len(ledger.failure_rows(spark.createDataFrame([("e", "c", "x" * 5000)], "event_id string, camera string, error string"), "now").first()["error"]) == 2000


GOOD = '{"objects": [{"label": " person ", "confidence": 0.9, "bbox": [0.1, 0.2, 0.5, 1.4]}]}'


@pytest.mark.parametrize("text,status", [(GOOD, "ok"), ('[{"label": "car", "confidence": 1, "bbox": [0, 0, 1, 1]}]', "ok"), ('{"objects": []}', "ok"), (f"```json\n{GOOD}\n```", "ok"), (None, "transport"), ("none", "rejected"), (GOOD.replace("0.9", "1.9"), "rejected"), (GOOD.replace("0.9", "true"), "rejected"), (GOOD.replace('"bbox"', '"extra": 1, "bbox"'), "rejected"), (GOOD.replace(" person ", " "), "rejected"), (GOOD.replace(" person ", "dragon"), "rejected"), (GOOD.replace("0.5,", "0.1,"), "rejected"), (GOOD.replace(", 1.4", ""), "rejected"), ('{"objects": [], "more": 1}', "rejected"), ('{"items": []}', "rejected")])
def test_model_output(spark, text, status):
    r = scoring.parse_detections(spark.createDataFrame([(text,)], "content string"), allowed=["person", "car"]).first()
    assert r["status"] == status
    if text == GOOD:
        assert tuple(r["objects"][0]) == ("person", 0.9, 0.1, 0.2, 0.5, 1.0)


def test_verdict_text(spark):
    texts = ['x {"bbox_covers_object": true, "class_label": " car "} y', '{"bbox_covers_object": "true", "class_label": "car"}', '{"bbox_covers_object": true}', None]
    rows = scoring.parse_verdicts(spark.createDataFrame([(t,) for t in texts], "content string")).collect()
    assert [(r["covers"], r["vlm_label"], r["vlm_error"]) for r in rows] == [(True, "car", None), (None, None, "malformed"), (None, None, "malformed"), (None, None, "transport")]


def test_scoring_hook(spark):
    def make():
        def model(row):
            if row["n"] % 3 == 1:
                raise ValueError("bad row")
            if row["n"] % 3 == 2:
                raise RuntimeError("down")
            return {"score": row["n"] * 2.0}

        return model

    df = spark.range(9).selectExpr("id AS n")
    rows = {r["n"]: r for r in scoring.score_table(df, make, ["n"], "score double").collect()}
    assert {n: r["status"] for n, r in rows.items()} == {n: ("ok", "rejected", "transport")[n % 3] for n in range(9)}
    assert rows[6]["score"] == 12.0 and rows[1]["error"] == "bad row" and all(r["latency_ms"] >= 0 for r in rows.values())


def jobs_of(spark, work):
    """The number of Spark jobs that ``work`` starts, and its result."""
    group = f"counted-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), out
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_long_chain_needs_no_more_jobs_than_a_short_one(spark):
    def chain(n):
        h, rows, rng = 0, [], random.Random(1)
        for i in range(n):
            rows.append((f"f{i:05d}", "c", h - (1 << 64) if h >> 63 else h, float(i), "e", 0))
            h ^= 1 << rng.randrange(64)
        return spark.createDataFrame(rows, FRAMES), rows

    small, _ = chain(50)
    large, rows = chain(10_000)
    few, _ = jobs_of(spark, lambda: dedup.suppress_duplicates(small, 3).where("kept").count())
    many, n = jobs_of(spark, lambda: dedup.suppress_duplicates(large, 3).where("kept").count())
    kept = []
    for r in rows:
        if not any(((r[2] ^ k) & (1 << 64) - 1).bit_count() <= 3 for k in kept):
            kept.append(r[2])
    assert n == len(kept) and many <= few + 2


def test_passes_of_a_large_camera_equal_one_pass(spark):
    rng = random.Random(9)
    rows = [(f"f{i:04d}", rng.choice(["a", "a", "a", "b", None]), rng.getrandbits(20) - 5, float(rng.randint(0, 99)), f"e{i}", 0) for i in range(1500)] + [("n", "a", None, 0.0, "e", 0)]
    df = spark.createDataFrame(rows, FRAMES)
    near = lambda x, y: x[1] == y[1] and ((x[2] ^ y[2]) & (1 << 64) - 1).bit_count() <= 3
    wanted = greedy(sorted([r for r in rows if r[2] is not None], key=lambda f: (f[3], f[4], f[5], f[0])), near) | {"n"}
    for options in ({}, {"first_pass": 40, "lot": 16}):
        out = dedup.suppress_duplicates(df, 3, **options)
        assert {r["id"] for r in out.where("kept").collect()} == wanted and out.count() == len(rows)


def test_near_pairs_make_no_pairs_that_lie_further_apart(spark):
    """4,000 hashes at random, 30 bits apart or less in a third of their pairs, with a near copy of one in ten."""
    rng = random.Random(8)
    hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(4000)]
    near = [(min(h, h ^ 1 << 40 ^ 5), max(h, h ^ 1 << 40 ^ 5)) for h in hashes[:400]]
    df = spark.createDataFrame([(f"f{i}", "c", h, float(i), "e", 0) for i, h in enumerate({*hashes, *[x for p in near for x in p]})], FRAMES)
    pairs = nearhash.near_pairs(dedup.hash_classes(df), 10)
    assert sorted((r["a"], r["b"], r["distance"]) for r in pairs.collect()) == sorted((a, b, 3) for a, b in near)
    assert "SortMergeJoin" not in pairs._jdf.queryExecution().optimizedPlan().toString() and "bit_count" not in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_hash_tile_equals_comparing_all():
    import numpy as np

    draw = np.random.default_rng(4)
    base = draw.integers(0, 2**64, 600, dtype=np.uint64)
    hashes = np.unique(np.concatenate([base ^ np.bitwise_or.reduce([np.uint64(1) << draw.integers(0, 64, 600).astype(np.uint64) for _ in range(k)]) for k in range(1, 16)]))
    asked = draw.choice(hashes, 150)
    apart = np.bitwise_count(asked[:, None] ^ hashes[None, :])
    for threshold in (0, 1, 3, 10, 12, 20, 64):
        tile = nearhash.HashTile(hashes, threshold)
        assert tile.words or threshold not in (3, 10, 12)
        got = [(int(i), int(j), int(d)) for part in tile.near(asked) for i, j, d in zip(*part)]
        assert sorted(got) == sorted((int(i), int(j), int(apart[i, j])) for i, j in zip(*np.nonzero(apart <= threshold)))


def test_star_cover_stands_for_all_pairs(spark):
    """1,500 hashes within 8 bits of each other: as many rows, whatever the number of pairs."""
    rng = random.Random(2)
    hashes = {sum(1 << rng.randrange(64) for _ in range(4)) % (1 << 63) for _ in range(1500)}
    classes = dedup.hash_classes(spark.createDataFrame([(f"f{i}", "c", h, float(i), "e", 0) for i, h in enumerate(hashes)], FRAMES))
    cover = nearhash.star_cover(classes, 10, tile=400).cache()
    rows = cover.collect()
    reps = {r["rep"] for r in rows}
    assert len(rows) == len(hashes) and all((a ^ b).bit_count() > 10 for a in reps for b in reps if a < b)
    for r in rng.sample(rows, 60):
        assert (r["hash"] ^ r["rep"]).bit_count() == r["distance"] == min((r["hash"] ^ x).bit_count() for x in reps) <= 10
        assert r["links"] == sum((r["hash"] ^ h).bit_count() <= 10 for h in hashes) - 1
    assert nearhash.near_pairs(cover, 10).count() * 2 == sum(r["links"] for r in rows)
    assert nearhash.star_cover(classes.where("false")).count() == 0 == nearhash.near_pairs(nearhash.star_cover(classes.where("false"))).count()


def test_kept_hashes_equal_a_plain_search():
    import numpy as np

    rng = np.random.default_rng(8)
    for threshold in (0, 1, 7, 14, 30):
        kept, plain = nearhash.KeptHashes(threshold), np.empty(0, np.uint64)
        for n in (10, 5000, 3000, 6000):
            base = rng.integers(0, 1 << 62, 300).astype(np.uint64)
            new = base[rng.integers(300, size=n)] ^ (np.uint64(1) << rng.integers(0, 63, n).astype(np.uint64))
            kept.add(new)
            plain = np.concatenate([plain, new])
            asked = np.concatenate([new[:40] ^ np.uint64(0b10110), rng.integers(0, 1 << 62, 40).astype(np.uint64)])
            assert (kept.near(asked) == (np.bitwise_count(asked[:, None] ^ plain[None, :]) <= threshold).any(axis=1)).all()


def plain_match(predictions, truths, threshold):
    """Greedy over one pool: rows (id, confidence, box) and (id, box)."""
    taken, out = set(), {}
    for p, _, a in sorted(predictions, key=lambda x: (-x[1], x[0])):
        def iou(b, a=a):
            w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
            both = w * h if w > 0 and h > 0 else 0
            return both / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both) if both else 0
        found = sorted((-iou(b), t) for t, b in truths if t not in taken and iou(b) > threshold)
        out[p] = found[0][1] if found else None
        taken |= {out[p]} - {None}
    return out


def test_average_precision_goes_on_with_hits_only(spark, monkeypatch):
    """Equal to a plain curve where classes are cut by batches and parts and all confidences of a class are equal; one row a hit and a few totals are written."""
    rng = random.Random(6)
    rows = [(c, label, t, f"p{i:04d}", 0.5 if label == "dog" else rng.randint(0, 5) / 5, f"t{i}" if rng.random() < 0.2 else None) for c in "AB" for label in ("car", "dog", "cat") for t in (0.5, 0.75) for i in range(90)]
    rows = [(*r[:5], None) if r[:2] == ("B", "cat") else r for r in rows]
    matches = spark.createDataFrame(rows, "candidate string, label string, threshold double, prediction_id string, confidence double, truth_id string")
    truths = spark.createDataFrame([(c, label, f"t{i}") for c in "AB" for label in ("car", "dog", "cat", "cow") for i in range(100)], "candidate string, label string, truth_id string")
    tables, real = [], evaluate.written
    monkeypatch.setattr(evaluate, "written", lambda df: tables.append(real(df)) or tables[-1])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for base in ("matched", "truths"):
            got = {(r["candidate"], r["label"], r["threshold"]): r["ap"] for r in evaluate.average_precision(matches, truths, recall_base=base).collect()}
            assert len(got) == 16
            for key, ap in got.items():
                hits = [r[5] is not None for r in sorted((r for r in rows if r[:3] == key), key=lambda r: (-r[4], r[3]))]
                curve = [(sum(hits[: k + 1]) / (sum(hits) if base == "matched" else 100), sum(hits[: k + 1]) / (k + 1)) for k in range(len(hits)) if sum(hits)]
                wanted = sum(max((p for recall, p in curve if recall + 1e-9 >= level / 100), default=0.0) for level in range(101)) / 101
                assert abs(ap - wanted) < 1e-9, key
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(tables) == 2 and all(x.where("tp is not null").count() == sum(r[5] is not None for r in rows) and x.agg(F.sum("n")).first()[0] == len(rows) for x in tables)


@pytest.mark.parametrize("batch", [5, 10000])
def test_matching_within_images_equals_a_plain_fold(spark, batch):
    """Small groups, one of a thousand boxes and groups cut by batches; odd boxes and null keys match nothing. No list of boxes is folded by an interpreted function."""
    rng = random.Random(batch)

    def box():
        x, y = rng.choice([0.1, 0.12, 0.5]), rng.choice([0.3, 0.33])
        return [x, y, x + rng.choice([0.1, 0.12, 0.2]), y + 0.2]

    keys = [(c, f"i{i}", label) for c in "AB" for i in range(12) for label in ("car", "dog")]
    truths = [(*rng.choice(keys), f"t{i:03d}", *box()) for i in range(150)] + [("A", "big", "car", f"u{i:03d}", *box()) for i in range(300)]
    predictions = [(*rng.choice(keys), f"p{i:03d}", round(rng.random(), 1), *box()) for i in range(300)] + [("A", "big", "car", f"q{i:03d}", round(rng.random(), 1), *box()) for i in range(700)]
    odd = [("A", "i1", None, "p900", 0.5, 0.1, 0.3, 0.2, 0.5), ("A", "i1", "car", "p901", 0.5, 0.1, 0.3, None, 0.5), ("A", "i1", "car", "p902", None, 0.2, 0.3, 0.1, 0.5), ("C", "i1", "car", "p903", 0.5, 0.1, 0.3, 0.2, 0.5)]
    ps = spark.createDataFrame(predictions + odd, "candidate string, image_id string, label string, prediction_id string, confidence double, x1 double, y1 double, x2 double, y2 double")
    ts = spark.createDataFrame(truths + [("A", "i1", None, "t900", 0.1, 0.3, 0.2, 0.5), ("A", "i2", "car", "t901", 0.1, 0.3, 0.1, 0.5)], "candidate string, image_id string, label string, truth_id string, x1 double, y1 double, x2 double, y2 double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = evaluate.match(ps, ts, (0.3, 0.5, 0.9))
        got = out.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out.columns == ["candidate", "image_id", "label", "threshold", "prediction_id", "confidence", "truth_id"]
    assert len(got) == 3 * (len(predictions) + len(odd)) and all(r["truth_id"] is None for r in got if r["prediction_id"] > "p9" and r["prediction_id"] < "q")
    for key in [*keys, ("A", "big", "car")]:
        for threshold in (0.3, 0.5, 0.9):
            own = [(p[3], p[4], p[5:]) for p in predictions if p[:3] == key]
            wanted = plain_match(own, [(t[3], t[4:]) for t in truths if t[:3] == key], threshold)
            assert {r["prediction_id"]: r["truth_id"] for r in got if (r["candidate"], r["image_id"], r["label"], r["threshold"]) == (*key, threshold) and not "p9" < r["prediction_id"] < "q"} == wanted
    assert evaluate.match(ps.where("false"), ts).count() == 0
    assert "aggregate(" not in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("seed,equal", [(1, False), (2, True)])
def test_pooled_matching_equals_a_plain_fold(spark, seed, equal):
    rng = random.Random(seed)

    def box():
        w, h = (rng.choice([0.1, 0.2]), 0.2) if equal else (2 ** rng.uniform(-7, -1), 2 ** rng.uniform(-7, -1))
        x, y = (rng.choice([0.1, 0.12, 0.5]), 0.3) if equal else (rng.uniform(0, 0.6), rng.uniform(0, 0.6))
        return [x, y, x + w, y + h]

    def shaken(b):
        return b if equal else [b[0] + rng.uniform(-0.1, 0.1) * (b[2] - b[0]), b[1], b[2], b[3] + rng.uniform(-0.2, 0.2) * (b[3] - b[1])]

    truths = [(rng.choice("AB"), rng.choice(["car", "dog"]), f"t{i:03d}", *box()) for i in range(150)] + [("A", "cat", "t999", 0.1, 0.1, 0.2, 0.2)]
    predictions = [(*rng.choice(truths)[:2], f"p{i:03d}", round(rng.random(), 1), *shaken(rng.choice(truths)[3:])) for i in range(220)] + [("B", "cow", "p999", 0.5, 0.1, 0.1, 0.2, 0.2), ("A", "cat", "p998", 0.5, 0.2, 0.1, 0.2, 0.2)]
    ps = spark.createDataFrame(predictions, "candidate string, label string, prediction_id string, confidence double, x1 double, y1 double, x2 double, y2 double")
    ts = spark.createDataFrame(truths, "candidate string, label string, truth_id string, x1 double, y1 double, x2 double, y2 double")
    got = evaluate.match(ps, ts, (0.3, 0.5, 0.9), scope="pooled").collect()
    assert len(got) == 3 * len(predictions)
    for c in "AB":
        for label in ("car", "dog", "cat", "cow"):
            for threshold in (0.3, 0.5, 0.9):
                own = [(p[2], p[3], p[4:]) for p in predictions if p[:2] == (c, label)]
                wanted = plain_match(own, [(t[2], t[3:]) for t in truths if t[:2] == (c, label)], threshold)
                assert {r["prediction_id"]: r["truth_id"] for r in got if (r["candidate"], r["label"], r["threshold"]) == (c, label, threshold)} == wanted
    assert evaluate.match(ps.where("false"), ts, scope="pooled").count() == 0
    assert evaluate.match(ps, ts.where("false"), (0.5,), scope="pooled").where("truth_id is null").count() == len(predictions)


CANDIDATES = "name string, map50 double, recall double, latency_ms double"


def plain_front(rows):
    inf = float("inf")
    point = lambda x: (x[1], x[2], -(x[3] or inf))
    better = lambda b, a: None not in (*b[1:3], *a[1:3]) and b[0] != a[0] and all(x >= y for x, y in zip(point(b), point(a))) and point(b) != point(a)
    return sorted((a for a in rows if not any(better(b, a) for b in rows)), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_frontier_equals_all_comparisons(spark, seed):
    """Ties in every measure, rows of one name, null measures and latencies."""
    rng = random.Random(seed)
    value = lambda n: rng.choice([None, *[i / n for i in range(n)]] if seed else [rng.random()])
    rows = [(f"m{rng.randrange(3 if seed == 2 else 80)}", value(6), value(5), rng.choice([None, 0.0, 1.0, 2.0, 5.0, rng.random()])) for _ in range(300)]
    df = spark.createDataFrame(rows, CANDIDATES).repartition(7)
    assert sorted((tuple(r) for r in evaluate.pareto_frontier(df).collect()), key=str) == plain_front(rows)
    assert evaluate.pareto_frontier(df.where("false")).count() == 0


def test_frontier_of_many_rows_without_an_order(spark):
    """200,000 candidates that hardly dominate each other."""
    df = spark.range(200_000).select(F.concat(F.lit("m"), "id").alias("name"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    df = df.select("name", F.col("a").alias("map50"), F.col("b").alias("recall"), (1 + F.col("a") + F.col("b")).alias("latency_ms"))
    assert evaluate.pareto_frontier(df).count() == 200_000


def test_two_best_names_of_a_prefix():
    import numpy as np

    rng = random.Random(7)
    points = [(rng.randrange(9) / 9, rng.randrange(20), rng.choice("abc")) for _ in range(150)]
    best = skyline.BestNames(np.array([p[0] for p in points]))
    for i, (r, latency, name) in enumerate(points):
        names = {n for x, y, n in points[:i] if x >= r and y <= latency}
        found = best.within(r, latency)
        assert len(found) == min(2, len(names)) and set(found) <= names
        best.add(r, latency, name)


def test_ranks_of_a_hot_group_in_many_ranges(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 10 < 9.5, None).otherwise("cold").alias("g"), (F.col("id") * 7919 % 20_011).alias("k"), "id")
    out = ranges.ranked(df, ["g"], [F.asc("k")], "place").cache()
    wrong = out.withColumn("_w", F.expr("row_number() over (partition by g order by k)")).where("_w <> place")
    assert wrong.count() == 0 and out.count() == 20_000 and out.columns == [*df.columns, "place"]
    cut = ranges.cut(df, ["g"], [F.asc("k")]).where("g = 'hot'").groupBy("_part").count().agg(F.max("count"), F.expr("median(count)")).first()
    assert cut[0] <= 2 * cut[1]


def test_coverage_equals_all_comparisons(spark):
    """Windows from an instant to years, with samples at their edges, nulls and strange columns."""
    rng = random.Random(4)
    windows = [(rng.choice(["a", "b", None]), s := float(rng.randrange(0, 10_000_000, 50_000)), rng.choice([s, s + 1, s + 90_000, s + 4e7, None]), i) for i in range(300)] + [("a", None, 5.0, 300)]
    samples = [(rng.choice(["a", "b", "c", None]), rng.choice([None, float(rng.randrange(0, 12_000_000, 50_000)), float(rng.randrange(12_000_000))])) for _ in range(60)]
    w = spark.createDataFrame(windows, "camera string, start double, end double, _first long")
    out = sessions.mark_covered(w.withColumnRenamed("_first", "n"), spark.createDataFrame(samples, "camera string, ts double"))
    got = {r["n"]: r["covered"] for r in out.collect()}
    assert out.columns == ["camera", "start", "end", "n", "covered"] and len(got) == len(windows)
    inside = lambda w, s: None not in (*w[:3], *s) and w[0] == s[0] and w[1] <= s[1] <= w[2]
    assert got == {w[3]: any(inside(w, s) for s in samples) for w in windows}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_one_run_with_all_rows_is_cut_into_ranges(spark):
    rng = random.Random(12)
    rows = [("r", i, rng.random() < 0.55) for i in range(4000)] + [("q", i, i % 3 > 0) for i in range(50)]
    df = spark.createDataFrame(rows, "run string, n int, failed boolean").repartition(5)
    for streak in (3, 12, 60):
        want = []
        for run in "rq":
            bad = 0
            for r in [x for x in rows if x[0] == run]:
                want.append(r[:2])
                bad = bad + 1 if r[2] else 0
                if bad == streak:
                    break
        got = sessions.until_failure_streak(df, "run", ["n"], "failed", streak)
        assert got.columns == df.columns and sorted((r["run"], r["n"]) for r in got.collect()) == sorted(want)


def test_pooled_matching_writes_no_pairs(spark, monkeypatch):
    """Every prediction meets every truth: the pairs are 160,000, the matches 400."""
    from framelake import lineage

    def refused(_):
        raise AssertionError("a table was written")

    ps = spark.range(400).selectExpr("'A' candidate", "'car' label", "concat('p', id) prediction_id", "id / 400D confidence", "0D x1", "0D y1", "1D + id / 1e6 x2", "1D y2")
    ts = spark.range(400).selectExpr("'A' candidate", "'car' label", "concat('t', id) truth_id", "0D x1", "0D y1", "1D + id / 1e6 x2", "1D y2")
    monkeypatch.setattr(lineage, "shared_folder", refused)
    got = evaluate.match(ps, ts, (0.5,), scope="pooled").collect()
    assert {r["prediction_id"][1:] for r in got} == {r["truth_id"][1:] for r in got} and len(got) == 400



@pytest.mark.parametrize("kind", ["spread", "crowded", "equal"])
@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.9])
def test_pooled_matching_by_levels_equals_a_plain_fold(monkeypatch, kind, threshold):
    """Truths are sought above high levels first, though those before in a block may have taken what a level shows."""
    import numpy as np

    rng = random.Random(5)

    def box():
        if kind == "equal":
            x, w = rng.choice([0.1, 0.12, 0.5]), rng.choice([0.1, 0.2])
            return [x, 0.3, x + w, 0.5]
        x, y, w, h = (rng.uniform(0, 0.01) if kind == "crowded" else rng.uniform(0, 0.4) for _ in range(4))
        return [x, y, x + 0.05 + w, y + 0.05 + h]

    monkeypatch.setattr(matching, "FEW", 0)
    monkeypatch.setattr(matching, "LOOKED", 300)
    truths, asked = [box() for _ in range(250)], [box() for _ in range(600)]
    first = matching._index_class()(np.array(truths), 0.6)
    first.match(np.array(asked[:300]))
    index = first.at(threshold)
    got = np.concatenate([index.match(np.array(asked[i:j])) for i, j in ((0, 7), (7, 550), (550, 600))]).tolist()
    wanted = plain_match([(i, -i, b) for i, b in enumerate(asked)], list(enumerate(truths)), threshold)
    assert {i: None if rank < 0 else rank for i, rank in enumerate(got)} == wanted


def test_pooled_matching_looks_at_few_truths_of_a_large_pool():
    """20,000 different truths, of which a prediction overlaps some hundreds by half."""
    import numpy as np

    rng = np.random.default_rng(3)

    def some(n):
        x, y, w, h = rng.random((4, n)) * [[0.5], [0.5], [0.4], [0.3]]
        return np.stack([x, y, x + 0.01 + w, y + 0.05 + h], axis=1)

    index, looked = matching._index_class()(some(20_000), 0.5), []
    hits = index.hits

    def counted(p, who, start, n, *rest):
        looked.append(int(n.sum()))
        return hits(p, who, start, n, *rest)

    index.hits = counted
    assert (index.match(some(4000)) >= 0).mean() > 0.9 and sum(looked) < 400 * 4000


def test_golden_validation_sends_no_table_to_all_tasks(spark):
    rows = spark.createDataFrame([("a", "i.jpg"), ("b", "j.jpg"), ("b", "i.jpg"), (None, "i.jpg")], "sample_id string, image string")
    images = spark.createDataFrame([("i.jpg",)] * 5, "image string")
    out = datasets.validate_golden(rows, images, spark.createDataFrame([("a",)] * 3, "sample_id string").limit(3))
    assert sorted(map(tuple, out.collect()), key=str) == [("b", "duplicate_id"), ("b", "missing_image"), ("b", "missing_label"), ("b", "missing_label"), (None, "missing_id")]
    joins = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert joins and not [line for line in joins if "Broadcast" in line]
