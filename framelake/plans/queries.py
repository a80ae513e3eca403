"""Registered queries over the derived views, each beside the SQL that checks it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import boxes, hashes, labels, times
from ..operators import datasets, dedup, evaluate, ledger, nearhash, pool, reconcile, scoring, sessions, store
from ..lineage import discard, shared_folder, written
from ..sources import feeds
from ..streaming import audit, incremental
from .views import duck_sql, spark_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CLASSES = ["person", "car", "dog"]


class Tables:
    """Views by attribute, for one session and folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return spark_view(self.spark, self.sf_dir, name)


def query(sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[build.__name__] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[build.__name__] = duck_sql(sql)
        return build

    return register


def _class_table(t: Tables) -> DataFrame:
    return labels.class_table(t.spark, CLASSES)


IOU = """CASE WHEN {a}.x2 > {b}.x1 AND {b}.x2 > {a}.x1 AND {a}.y2 > {b}.y1 AND {b}.y2 > {a}.y1 THEN
 (least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * (least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))
 / (({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1) + ({b}.x2 - {b}.x1) * ({b}.y2 - {b}.y1)
    - (least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * (least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))) ELSE 0 END"""
PROPER = "x2 > x1 AND y2 > y1 AND x1 IS NOT NULL AND y2 IS NOT NULL"

# --- pool


@query("""
SELECT s.*, a.verified_samples, a.verified_boxes FROM
 (SELECT count(*) AS total, count(*) FILTER (verified = 1) AS verified, count(*) FILTER (verified <> 1) AS unverified,
         count(*) FILTER (quality = 'useful') AS useful, count(*) FILTER (quality = 'bad') AS bad, count(*) FILTER (quality = 'duplicate') AS duplicate,
         count(*) FILTER (quality = 'ignore') AS "ignore", count(*) FILTER (quality IN ('bad', 'duplicate')) AS problematic FROM {samples}) s,
 (SELECT count(DISTINCT sample_id) AS verified_samples, count(*) AS verified_boxes FROM {annotations} WHERE verified = 1) a""")
def a01_quality_counts(t):
    return pool.quality_counts(t.samples, t.annotations)


@query("""SELECT (SELECT count(*) FROM {samples}) AS total, (SELECT count(*) FROM {annotations} WHERE verified = 1) AS verified_boxes,
 (SELECT string_agg(camera, ',' ORDER BY camera) FROM (SELECT DISTINCT camera FROM {samples})) AS cameras""")
def a02_overview(t):
    return pool.overview(t.samples, t.annotations).select("total", "verified_boxes", F.array_join("cameras", ",").alias("cameras"))


@query("SELECT status, count(*) AS n FROM {samples} GROUP BY status")
def a03_status_counts(t):
    return pool.status_counts(t.samples)


@query("""SELECT (SELECT count(*) FROM {samples}) AS samples, (SELECT count(*) FROM {annotations} WHERE verified = 0) AS unverified_annotations,
 (SELECT count(*) FROM {event_feed} WHERE end_time IS NULL) AS failures""")
def a04_pool_statistics(t):
    return pool.pool_statistics(t.samples, t.annotations, t.event_feed.where("end_time is null"))


@query("SELECT camera, count(*) AS n FROM {samples} GROUP BY camera ORDER BY n DESC, camera LIMIT 20")
def k02_top_cameras(t):
    return pool.top_cameras(t.samples)


@query("""SELECT label, count(*) AS n, count(*) / cast(max(count(*)) OVER () AS double) AS share FROM {annotations} WHERE verified = 1 GROUP BY label""")
def a05_class_shares(t):
    return pool.class_shares(t.annotations)


@query("""SELECT s.id, count(a.id) AS n_annotations FROM {samples} s LEFT JOIN {annotations} a ON a.sample_id = s.id GROUP BY s.id""")
def a07_annotation_counts(t):
    return pool.annotation_counts(t.samples, t.annotations).select("id", "n_annotations")


@query("""SELECT s.id, s.camera, s.ts, count(a.id) AS n_annotations, count(a.id) > 0 AS has_annotations, concat('/images/', s.id) AS image_url
FROM {samples} s LEFT JOIN {annotations} a ON a.sample_id = s.id
WHERE s.status = 'collected' AND s.quality = 'useful' AND s.id IN (SELECT sample_id FROM {annotations} WHERE label = 'person') GROUP BY s.id, s.camera, s.ts""")
def f01_search(t):
    found = pool.search(t.samples, t.annotations, status="collected", quality="useful", label="person")
    return found.select("id", "camera", "ts", "n_annotations", "has_annotations", "image_url")


@query("""SELECT id, ts, total FROM (SELECT id, ts, count(*) OVER () AS total FROM {samples} WHERE status = 'collected') ORDER BY ts DESC, id LIMIT 50 OFFSET 100""")
def k01_page(t):
    return pool.page(t.samples.where("status = 'collected'"), 50, 100).select("id", "ts", "total")


@query("""SELECT s.id, count(a.id) AS n, coalesce(string_agg(a.id, ',' ORDER BY a.created_at, a.id), '') AS annotation_ids,
 count(a.id) FILTER (x1 IS NOT NULL AND y1 IS NOT NULL AND x2 IS NOT NULL AND y2 IS NOT NULL) AS with_box
FROM {samples} s LEFT JOIN {annotations} a ON a.sample_id = s.id GROUP BY s.id""")
def f02_sample_view(t):
    v = pool.sample_view(t.samples, t.annotations)
    return v.select("id", F.size("annotations").cast("long").alias("n"), F.array_join("annotations.id", ",").alias("annotation_ids"), F.size(F.filter("annotations", lambda a: a["box"].isNotNull())).cast("long").alias("with_box"))


@query("""SELECT id, camera, ts FROM {samples} WHERE camera IN ('cam1', 'cam2', 'cam3') AND quality = 'useful'
 AND id IN (SELECT sample_id FROM {annotations} WHERE label IN ('car', 'dog')) ORDER BY ts DESC, id LIMIT 50000""")
def f03_report_records(t):
    return pool.report_records(t.samples, t.annotations, cameras=["cam1", "cam2", "cam3"], labels=["car", "dog"], quality="useful").select("id", "camera", "ts")


@query("""WITH d AS (SELECT camera, strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y%m%d') AS day, id, ts FROM {samples} WHERE quality = 'useful')
SELECT camera, day, string_agg(id, ',' ORDER BY ts, id) AS frames, count(*) AS n, sum(count(*)) OVER (PARTITION BY camera)::BIGINT AS camera_frames FROM d GROUP BY camera, day""")
def a14_report_groups(t):
    g = pool.report_groups(t.samples.where("quality = 'useful'"))
    return g.select("camera", "day", F.array_join("frames", ",").alias("frames"), F.col("n").cast("long").alias("n"), "camera_frames")


@query("""WITH d AS (SELECT camera, strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y%m%d') AS day FROM {samples})
SELECT camera, day, count(*) AS n, grouping(camera, day)::BIGINT AS level FROM d GROUP BY ROLLUP (camera, day)""")
def a14_report_totals(t):
    return pool.report_totals(t.samples)


@query("""SELECT id, ts FROM {samples} WHERE (quality IS NULL OR quality <> 'bad') AND verified = 0 AND camera = 'cam4'
 AND id IN (SELECT sample_id FROM {annotations} WHERE label = 'person') ORDER BY ts, id""")
def f04_verify_candidates(t):
    return pool.verify_candidates(t.samples, t.annotations, camera="cam4", labels=["person"]).select("id", "ts")


@query("""SELECT id FROM {samples} WHERE status = 'collected' AND (quality IS NULL OR quality = 'useful') AND created_at >= '1995-01-01T00:00:00'
 AND id IN (SELECT sample_id FROM {annotations} WHERE label IN ('person', 'car'))""")
def f05_build_selection(t):
    return pool.build_selection(t.samples, t.annotations, labels=["person", "car"], since="1995-01-01T00:00:00").select("id")


@query("SELECT id FROM {samples} WHERE camera IN ('cam5', 'cam6') ORDER BY ts, id")
def f06_triage_batch(t):
    return pool.triage_batch(t.samples, t.annotations, cameras=["cam5", "cam6"])


@query(f"""SELECT id, label, CASE label WHEN 'person' THEN 0 WHEN 'car' THEN 1 ELSE 2 END AS class_id FROM {{annotations}}
WHERE label IN ('person', 'car', 'dog') AND {PROPER}""")
def f07_usable_boxes(t):
    return pool.usable_boxes(t.annotations, _class_table(t)).select("id", "label", "class_id")


@query("""SELECT id, CASE WHEN end_time IS NULL THEN 'failed'
 WHEN NOT (box[1] >= 0 AND box[2] >= 0 AND box[1] + box[3] <= 1 AND box[2] + box[4] <= 1 AND box[3] > 0 AND box[4] > 0 AND box[1] < box[1] + box[3] AND box[2] < box[2] + box[4]) THEN 'skipped' ELSE 'ok' END AS outcome FROM {event_feed}""")
def f10_refused_events(t):
    return feeds.refused_events(t.event_feed.withColumn("box", boxes.from_xywh(F.col("box"))), crops=True).select("id", "outcome")


@query("SELECT name, latency_ms, map50 FROM {candidates} WHERE latency_ms IS NOT NULL AND map50 IS NOT NULL")
def f11_scatter_points(t):
    return pool.scatter_points(t.candidates).select("name", "latency_ms", "map50")


@query("""SELECT a.id, a.label, s.camera, s.ts FROM {annotations} a JOIN {samples} s ON s.id = a.sample_id""")
def j01_annotated_samples(t):
    return pool.annotated_samples(t.annotations, t.samples).select("id", "label", "camera", "ts")


@query("""WITH p AS (SELECT a.id, label, least(greatest(x1 * 1920, 0), 1920) AS px1, least(greatest(y1 * 1080, 0), 1080) AS py1, least(greatest(x2 * 1920, 0), 1920) AS px2, least(greatest(y2 * 1080, 0), 1080) AS py2,
 CASE WHEN x1 IS NULL OR y1 IS NULL OR x2 IS NULL OR y2 IS NULL THEN 'missing_box' WHEN x2 <= x1 OR y2 <= y1 THEN 'degenerate_box' WHEN px2 <= px1 OR py2 <= py1 THEN 'outside_image' END AS skip_reason
FROM {annotations} a JOIN {samples} s ON s.id = a.sample_id WHERE a.source = 'feed' AND trim(label) <> '' AND image_path IS NOT NULL)
SELECT id, label, skip_reason, CASE WHEN skip_reason IS NULL THEN px1 END AS x1, CASE WHEN skip_reason IS NULL THEN py1 END AS y1, CASE WHEN skip_reason IS NULL THEN px2 END AS x2, CASE WHEN skip_reason IS NULL THEN py2 END AS y2 FROM p""")
def s09_pool_objects(t):
    return pool.pool_objects(t.annotations, t.samples, "feed", 1920, 1080).select("id", "label", "skip_reason", "box.*")


@query("SELECT id FROM {samples} WHERE id IN (SELECT sample_id FROM {annotations} WHERE label = 'dog')")
def j02_label_semi_join(t):
    return pool.with_label(t.samples, t.annotations, ["dog"]).select("id")


@query("""SELECT event_id, count(*) AS n FROM (SELECT concat('e', cast(o_orderkey * 2 AS varchar)) AS event_id FROM {orders})
WHERE event_id NOT IN (SELECT event_id FROM {samples}) AND event_id NOT IN (SELECT event_id FROM {annotations}) GROUP BY event_id""")
def j03_without_known_events(t):
    found = t.orders.select(F.concat(F.lit("e"), (F.col("o_orderkey") * 2).cast("string")).alias("id"), F.lit(0.0).alias("start_time"))
    return dedup.without_known_events(found, t.samples, t.annotations).groupBy(F.col("id").alias("event_id")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id FROM {samples} UNION SELECT event_id FROM {annotations}")
def k04_known_events(t):
    return t.samples.select("event_id").union(t.annotations.select("event_id")).distinct()


@query("SELECT label FROM {predictions} UNION SELECT label FROM {truths}")
def k05_label_universe(t):
    return pool.label_universe(t.predictions, t.truths)


# --- motion and sessions

WINDOWS = """w AS (SELECT camera, min(start_time)::DOUBLE AS start, max(start_time) + 1.0::DOUBLE AS "end", max(motion) AS peak_motion, count(*) AS buckets FROM
 (SELECT *, sum(new) OVER (PARTITION BY camera ORDER BY start_time RANGE UNBOUNDED PRECEDING) AS grp FROM
  (SELECT *, CASE WHEN start_time - (lag(start_time) OVER (PARTITION BY camera ORDER BY start_time) + 1.0) > 600 THEN 1 ELSE 0 END AS new FROM {motion} WHERE motion >= 0.3))
 GROUP BY camera, grp)"""


def _windows(t: Tables) -> DataFrame:
    return sessions.motion_windows(t.motion, 0.3, 600)


def _moved(t: Tables) -> DataFrame:
    """Samples moved into the years of the motion table."""
    return t.event_feed.where("end_time is not null").select("camera", (F.col("start_time") % 2592000 + 1704067200).alias("ts"))


@query(f"""WITH {WINDOWS} SELECT camera, start, "end"::DOUBLE AS "end", peak_motion, buckets FROM w""")
def w01_motion_windows(t):
    return _windows(t)


COVERED = WINDOWS + """, p AS (SELECT camera, start_time - floor(start_time / 2592000) * 2592000 + 1704067200 AS ts FROM {event_feed} WHERE end_time IS NOT NULL)"""


@query(f"""WITH {COVERED} SELECT camera, start, EXISTS (SELECT 1 FROM p WHERE p.camera = w.camera AND p.ts BETWEEN w.start AND w."end") AS covered FROM w""")
def j04_mark_covered(t):
    return sessions.mark_covered(_windows(t), _moved(t)).select("camera", "start", "covered")


@query(f"""WITH {COVERED} SELECT camera, start FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.camera = w.camera AND p.ts BETWEEN w.start AND w."end")""")
def k06_uncovered(t):
    return sessions.uncovered(sessions.mark_covered(_windows(t), _moved(t))).select("camera", "start")


@query(f"""WITH {COVERED} SELECT camera, start, CASE WHEN EXISTS (SELECT 1 FROM p WHERE p.camera = w.camera AND p.ts BETWEEN w.start AND w."end")
 THEN 'covered by samples' ELSE 'no samples in window' END AS notes FROM w WHERE start % 2 = 0""")
def m05_store_windows(t):
    found = sessions.mark_covered(_windows(t), _moved(t))
    return sessions.store_windows(found.where("start % 2 = 1"), found.union(found)).select("camera", "start", "notes")


@query(f"""WITH {WINDOWS} SELECT camera, start FROM w ORDER BY start DESC, camera LIMIT 25""")
def k02_newest_windows(t):
    return sessions.newest_windows(_windows(t), 25).select("camera", "start")


@query("""WITH b AS (SELECT *, CASE WHEN content IS NULL THEN 1 ELSE 0 END AS bad, row_number() OVER (PARTITION BY batch ORDER BY run_order, id) AS n FROM {responses}),
g AS (SELECT *, sum(1 - bad) OVER (PARTITION BY batch ORDER BY n) AS grp FROM b),
s AS (SELECT *, sum(bad) OVER (PARTITION BY batch, grp ORDER BY n) AS streak FROM g),
stop AS (SELECT batch, min(n) FILTER (streak >= 3) AS last FROM s GROUP BY batch)
SELECT s.batch, count(*) AS handled, sum(bad)::BIGINT AS failures FROM s JOIN stop USING (batch) WHERE last IS NULL OR n <= last GROUP BY s.batch""")
def w10_failure_streak(t):
    r = t.responses.withColumn("failed", F.col("content").isNull())
    kept = sessions.until_failure_streak(r, "batch", ["run_order", "id"], "failed", 3, F.floor(F.col("run_order") / 1000))
    return kept.groupBy("batch").agg(F.count(F.lit(1)).alias("handled"), F.sum(F.col("failed").cast("long")).alias("failures"))


# --- duplicates


@query("""SELECT id, CASE WHEN image_hash IS NULL THEN id ELSE first_value(id) OVER (PARTITION BY camera, image_hash ORDER BY created_at, id) END AS first_id FROM {samples}""")
def j05_exact_duplicates(t):
    return dedup.exact_duplicates(t.samples).select("id", "first_id")


@query("""SELECT DISTINCT s.first_id AS sample_id, concat(s.event_id, 'x') AS event_id FROM
 (SELECT *, first_value(id) OVER (PARTITION BY camera, image_hash ORDER BY created_at, id) AS first_id FROM {samples} WHERE image_hash IS NOT NULL) s WHERE s.first_id <> s.id""")
def j07_merge_events(t):
    later = dedup.exact_duplicates(t.samples).where("image_hash is not null and first_id <> id").select(F.col("first_id").alias("sample_id"), F.concat("event_id", F.lit("x")).alias("event_id"))
    return dedup.merge_events(t.annotations, later).select("sample_id", "event_id")


def _frames(t: Tables) -> DataFrame:
    grid = F.concat("embedding", F.slice("embedding", 1, 8))  # 64 values as eight rows of nine
    h = hashes.bits_to_long(hashes.difference_hash(grid, 8))
    return t.embeddings.select(F.concat(F.lit("f"), F.col("vec_id").cast("string")).alias("id"), F.concat(F.lit("cam"), (F.col("label") % 4).cast("string")).alias("camera"), h.alias("hash"), F.col("vec_id").cast("double").alias("ts"), F.lit("e").alias("event_id"), F.lit(0).alias("frame_index"))


DHASH = """h AS (SELECT vec_id, concat('f', vec_id::VARCHAR) AS id, concat('cam', (label % 4)::VARCHAR) AS camera,
 list_transform(range(0, 64), lambda p: CASE WHEN list_concat(embedding, embedding[1:8])[(p // 8) * 9 + p % 8 + 1] >= list_concat(embedding, embedding[1:8])[(p // 8) * 9 + p % 8 + 2] THEN 1 ELSE 0 END) AS bits FROM embeddings),
u AS (SELECT vec_id, id, camera, list_sum(list_transform(range(0, 64), lambda p: bits[p + 1]::HUGEINT * (1::HUGEINT << (63 - p)::INT)))::HUGEINT AS v FROM h),
g AS (SELECT vec_id, id, camera, (CASE WHEN v >= 9223372036854775808 THEN v - 18446744073709551616 ELSE v END)::BIGINT AS hash FROM u)"""


@query(f"""WITH {DHASH} SELECT id, camera, hash FROM g""")
def h01_difference_hash(t):
    return _frames(t).select("id", "camera", "hash")


@query(f"""WITH {DHASH}, k AS (SELECT camera, hash, count(*) AS n FROM g GROUP BY ALL)
SELECT l.camera, l.hash AS a, r.hash AS b, bit_count(xor(l.hash, r.hash))::INT AS distance, l.n AS n_a, r.n AS n_b FROM k l JOIN k r ON l.camera = r.camera AND l.hash < r.hash WHERE bit_count(xor(l.hash, r.hash)) <= 10""")
def j06_near_pairs(t):
    """The pairs that the star cover stands for."""
    classes = written(dedup.hash_classes(_frames(t)))
    of = lambda n: classes.select("camera", F.col("hash").alias(n), F.col("n").alias(f"n_{n}")).hint("merge")
    return nearhash.near_pairs(classes, 10).join(of("a"), ["camera", "a"]).join(of("b"), ["camera", "b"]).select("camera", "a", "b", "distance", "n_a", "n_b")


@query(f"""WITH {DHASH}, k AS (SELECT camera, hash, min(vec_id) AS first, count(*) AS n FROM g GROUP BY ALL),
o AS (SELECT camera, list(hash ORDER BY first) AS hs FROM k GROUP BY camera),
r AS (SELECT camera, unnest(list_reduce(list_transform(hs, lambda h: [h]), lambda acc, x: CASE WHEN len(list_filter(acc, lambda q: bit_count(xor(q, x[1])) <= 10)) > 0 THEN acc ELSE list_concat(acc, x) END)) AS rep FROM o),
x AS (SELECT k.camera, k.hash, k.n, r.rep, bit_count(xor(k.hash, r.rep))::INT AS distance, row_number() OVER (PARTITION BY k.camera, k.hash ORDER BY bit_count(xor(k.hash, r.rep)), r.rep) AS o FROM k JOIN r ON r.camera = k.camera),
l AS (SELECT a.camera, a.hash, count(*) - 1 AS links FROM k a JOIN k b ON a.camera = b.camera AND bit_count(xor(a.hash, b.hash)) <= 10 GROUP BY ALL)
SELECT x.camera, x.hash, x.n, x.rep, x.distance, l.links FROM x JOIN l ON l.camera = x.camera AND l.hash = x.hash WHERE o = 1""")
def j06_star_cover(t):
    """One row for each different hash of a camera: its representative and the number of its links."""
    return nearhash.star_cover(dedup.hash_classes(_frames(t)), 10)


@query(f"""WITH {DHASH} SELECT DISTINCT l.camera, l.hash AS a, r.hash AS b, bit_count(xor(l.hash, r.hash))::INT AS distance FROM g l JOIN g r ON l.camera = r.camera
WHERE l.vec_id % 100 = 0 AND bit_count(xor(l.hash, r.hash)) <= 12""")
def h03_near_lookup(t):
    frames = _frames(t)
    return nearhash.near_hashes(frames.where("cast(ts as long) % 100 = 0"), frames, 12)


@query(f"""WITH {DHASH}, k AS (SELECT camera, hash, min(vec_id) AS first FROM g GROUP BY ALL),
o AS (SELECT camera, list(hash ORDER BY first) AS hs FROM k GROUP BY camera),
r AS (SELECT camera, list_reduce(list_transform(hs, lambda h: [h]), lambda acc, x: CASE WHEN len(list_filter(acc, lambda q: bit_count(xor(q, x[1])) <= 14)) > 0 THEN acc ELSE list_concat(acc, x) END) AS stay FROM o)
SELECT g.id, g.camera, list_contains(r.stay, g.hash) AND g.vec_id = k.first AS kept FROM g JOIN k ON k.camera = g.camera AND k.hash = g.hash JOIN r ON r.camera = g.camera""")
def w02_suppress_duplicates(t):
    return dedup.suppress_duplicates(_frames(t), 14).select("id", "camera", "kept")


@query(f"""WITH o AS (SELECT sample_id, label, list(a ORDER BY -verified, CASE source WHEN 'vlm' THEN 0 WHEN 'human' THEN 1 WHEN 'external' THEN 2 ELSE 3 END, created_at, id) AS boxes FROM {{annotations}} a GROUP BY ALL),
r AS (SELECT list_reduce(list_transform(boxes, lambda b: [b]), lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: coalesce({IOU.format(a="k", b="(x[1])")}, 0) > 0.5)) > 0 THEN acc ELSE list_concat(acc, x) END) AS kept FROM o)
SELECT k.id, k.sample_id, k.label, k.source FROM (SELECT unnest(kept) AS k FROM r)""")
def w03_without_overlaps(t):
    return dedup.without_overlaps(t.annotations).select("id", "sample_id", "label", "source")


@query(f"""SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY camera, ts, sample_id, id) <= 500 AS within_cap FROM
(SELECT a.*, s.camera, s.ts FROM {{annotations}} a JOIN {{samples}} s ON s.id = a.sample_id WHERE label IN ('person', 'car', 'dog') AND {PROPER})""")
def w04_cap_per_class(t):
    own = pool.annotated_samples(t.annotations, t.samples).drop("status", "quality")
    return dedup.cap_per_class(pool.usable_boxes(own, _class_table(t)), 500).select("id", "label", "within_cap")


@query("""WITH d AS (SELECT sample_id AS object_id, source AS prompt, label AS feed_label, confidence AS score, y1 AS mask_area, id AS idx,
 CASE source WHEN 'vlm' THEN 0 WHEN 'human' THEN 1 WHEN 'external' THEN 2 ELSE 3 END AS candidate_order FROM {annotations}),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY object_id, prompt ORDER BY score DESC, mask_area DESC, idx) AS n FROM d) WHERE n = 1)
SELECT object_id, prompt, idx FROM (SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY score DESC, candidate_order) AS m FROM b) WHERE m = 1""")
def w06_best_detection(t):
    d = t.annotations.select(F.col("sample_id").alias("object_id"), F.col("source").alias("prompt"), F.lit("none").alias("feed_label"), F.col("confidence").alias("score"), F.col("y1").alias("mask_area"), F.col("id").alias("idx"), dedup.overlap_priority(F.col("source")).alias("candidate_order"))
    return dedup.best_across_prompts(d).select("object_id", "prompt", "idx")


@query(f"""SELECT id FROM {{annotations}} WHERE {PROPER} AND confidence >= 0.95 AND least(x2, 0.5) > least(x1, 0.5) AND least(y2, 0.9) > least(y1, 0.9)
 AND floor((x2 - x1) * (y2 - y1) * 1000) > 0""")
def w07_clean_detections(t):
    area = F.floor((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) * 1000)
    d = t.annotations.select("id", boxes.box("x1", "y1", "x2", "y2").alias("box"), F.col("confidence").alias("score"), area.alias("mask_area"))
    return dedup.clean_detections(d, 0.95, 0.5, 0.9).select("id")


# --- dataset building

SPLIT = """CASE WHEN p < 0.8 THEN 'train' WHEN p < 0.9 THEN 'val' ELSE 'test' END"""
POINT = """(('0x' || substr(sha256('1:' || {0}), 1, 16))::UBIGINT)::DOUBLE / 18446744073709551616.0::DOUBLE"""


@query(f"""SELECT split, count(*) AS n FROM (SELECT {SPLIT.replace("0.9 ", "0.8 + 0.1 ").replace("0.8", "0.8::DOUBLE").replace("0.1 ", "0.1::DOUBLE ")} AS split FROM (SELECT {POINT.format("id")} AS p FROM {{samples}})) GROUP BY split""")
def h05_split_counts(t):
    return datasets.split_counts(t.samples.select("id"))


BUILD = f"""c AS (SELECT * FROM {{samples}} WHERE status = 'collected' AND (quality IS NULL OR quality = 'useful')),
a AS (SELECT x.*, c.camera, c.ts FROM {{annotations}} x JOIN c ON c.id = x.sample_id WHERE x.verified = 1),
u AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY camera, ts, sample_id, id) <= 400 AS ok FROM a WHERE label IN ('person', 'car') AND {PROPER}),
o AS (SELECT c.id AS sample_id, c.verified, CASE WHEN n_best IS NULL THEN 'no_box' WHEN n_usable IS NULL THEN 'class' WHEN n_kept = 0 THEN 'cap'
        WHEN c.image_path LIKE '%7.jpg' THEN 'no_image' ELSE 'written' END AS outcome, {POINT.format("c.id")} AS p
      FROM c LEFT JOIN (SELECT sample_id, count(*) AS n_best FROM a GROUP BY 1) b ON b.sample_id = c.id
      LEFT JOIN (SELECT sample_id, count(*) AS n_usable, count(*) FILTER (ok) AS n_kept FROM u GROUP BY 1) k ON k.sample_id = c.id)"""


def _build(t: Tables) -> DataFrame:
    images = t.samples.select("image_path").where("image_path not like '%7.jpg'")
    return datasets.build_outcomes(t.samples, t.annotations, labels.class_table(t.spark, ["person", "car"]), images, verified_only=True, max_per_class=400)


@query(f"""WITH {BUILD} SELECT sample_id, outcome, CASE WHEN outcome = 'written' THEN {SPLIT} END AS split FROM o""")
def b02_build_outcomes(t):
    return _build(t).select("sample_id", "outcome", "split")


@query(f"""WITH {BUILD} SELECT count(*) AS total, count(*) FILTER (outcome = 'written') AS written, count(*) FILTER (outcome = 'no_box') AS skipped_no_box,
 count(*) FILTER (outcome = 'class') AS skipped_class, count(*) FILTER (outcome = 'cap') AS skipped_cap, count(*) FILTER (outcome = 'no_image') AS skipped_no_image,
 count(*) FILTER (outcome = 'written' AND verified = 1) AS verified, count(*) FILTER (outcome = 'written' AND p < 0.8) AS train FROM o""")
def a13_build_summary(t):
    return datasets.build_summary(_build(t)).select("total", "written", "skipped_no_box", "skipped_class", "skipped_cap", "skipped_no_image", "verified", F.col("split_counts")["train"].alias("train"))


@query(f"""SELECT sample_id, string_agg(line, chr(10) ORDER BY id) AS body FROM (SELECT sample_id, id, printf('%d %.6f %.6f %.6f %.6f',
 CASE label WHEN 'person' THEN 0 WHEN 'car' THEN 1 ELSE 2 END, (x1 + x2) / 2, (y1 + y2) / 2, x2 - x1, y2 - y1) AS line
FROM {{annotations}} WHERE label IN ('person', 'car', 'dog') AND {PROPER}) GROUP BY sample_id""")
def s12_label_bodies(t):
    return datasets.label_bodies(pool.usable_boxes(t.annotations, _class_table(t))).select("sample_id", "body")


@query("""SELECT id AS sample_id, 'missing_image' AS problem FROM {samples} WHERE image_path LIKE '%9.jpg'
UNION ALL SELECT id, 'missing_label' FROM {samples} WHERE id NOT IN (SELECT sample_id FROM {annotations})""")
def b06_validate_golden(t):
    rows = t.samples.select(F.col("id").alias("sample_id"), F.col("image_path").alias("image"))
    return datasets.validate_golden(rows, rows.where("image not like '%9.jpg'"), t.annotations)


# --- evaluation

MATCHED = f"""th AS (SELECT unnest([0.5::DOUBLE, 0.75::DOUBLE]) AS threshold),
j AS (SELECT p.candidate, p.image_id, p.label, p.prediction_id, p.confidence, t.truth_id, {IOU.format(a="p", b="t")} AS iou
      FROM {{predictions}} p LEFT JOIN {{truths}} t ON t.candidate = p.candidate AND t.image_id = p.image_id AND t.label = p.label),
cands AS (SELECT candidate, image_id, label, threshold, prediction_id, confidence, coalesce(list(truth_id ORDER BY iou DESC, truth_id) FILTER (iou > threshold), []) AS near FROM j, th GROUP BY ALL),
f AS (SELECT candidate, image_id, label, threshold, list({{{{'pid': prediction_id, 'conf': confidence, 'tid': NULL::VARCHAR, 'near': near}}}} ORDER BY confidence DESC, prediction_id) AS ps FROM cands GROUP BY ALL),
z AS (SELECT candidate, image_id, label, threshold, list_reduce(list_concat([[{{{{'pid': '', 'conf': 0::DOUBLE, 'tid': NULL::VARCHAR, 'near': []::VARCHAR[]}}}}]], list_transform(ps, lambda x: [x])),
      lambda acc, x: list_concat(acc, [{{{{'pid': x[1].pid, 'conf': x[1].conf, 'tid': list_filter(x[1].near, lambda t: NOT list_contains(list_transform(acc, lambda a: coalesce(a.tid, '')), t))[1], 'near': []::VARCHAR[]}}}}])) AS out FROM f),
m AS (SELECT candidate, image_id, label, threshold, o.pid AS prediction_id, o.conf AS confidence, o.tid AS truth_id FROM (SELECT * EXCLUDE (out), unnest(out[2:]) AS o FROM z))"""


def _matches(t: Tables) -> DataFrame:
    return evaluate.match(t.predictions, t.truths, (0.5, 0.75))


@query(f"""WITH {MATCHED} SELECT candidate, label, threshold, prediction_id, truth_id FROM m""")
def e01_greedy_match(t):
    return _matches(t).select("candidate", "label", "threshold", "prediction_id", "truth_id")


BATCH = "substr(image_id, greatest(1, length(image_id) - 1))"
POOLED = MATCHED.replace("AND t.image_id = p.image_id", "AND t.batch = p.batch").replace("p.image_id", "p.batch AS image_id").replace("{predictions}", "pb").replace("{truths}", "tb")


@query(f"""WITH pb AS (SELECT *, {BATCH} AS batch FROM {{predictions}}), tb AS (SELECT *, {BATCH} AS batch FROM {{truths}}), {POOLED}
SELECT candidate, image_id AS batch, label, threshold, prediction_id, truth_id FROM m""")
def e01_pooled_match(t):
    """Batches of images are evaluated as one pool each: boxes match across the images of a batch."""
    batch = F.expr(BATCH).alias("batch")
    out = evaluate.match(t.predictions.select("*", batch), t.truths.select("*", batch), (0.5, 0.75), ("candidate", "batch"), scope="pooled")
    return out.select("candidate", "batch", "label", "threshold", "prediction_id", "truth_id")


AP = MATCHED + """, r AS (SELECT *, sum(CASE WHEN truth_id IS NULL THEN 0 ELSE 1 END) OVER w AS tp, count(*) OVER w AS k, sum(CASE WHEN truth_id IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY candidate, label, threshold) AS total FROM m
 WINDOW w AS (PARTITION BY candidate, label, threshold ORDER BY confidence DESC, prediction_id ROWS UNBOUNDED PRECEDING)),
x AS (SELECT candidate, label, threshold, least(100, floor(tp * 100 / total::DOUBLE + 1e-9)) AS lvl, tp / k::DOUBLE AS prec FROM r WHERE total > 0),
g AS (SELECT candidate, label, threshold, i, max(prec) AS prec FROM x JOIN (SELECT unnest(range(0, 101)) AS i) q ON x.lvl >= q.i GROUP BY ALL),
n AS (SELECT candidate, label, count(*) AS n_truths FROM {truths} GROUP BY ALL),
ap AS (SELECT n.candidate, n.label, th.threshold, n.n_truths, coalesce((SELECT sum(prec) FROM g WHERE g.candidate = n.candidate AND g.label = n.label AND g.threshold = th.threshold), 0) / 101 AS ap FROM n, th)"""


@query(f"""WITH {AP} SELECT candidate, label, threshold, n_truths, round(ap * 1000000)::BIGINT AS ap_millionths FROM ap""")
def e02_average_precision(t):
    ap = evaluate.average_precision(written(_matches(t)), t.truths, thresholds=(0.5, 0.75))
    return ap.select("candidate", "label", "threshold", "n_truths", F.round(F.col("ap") * 1000000).cast("long").alias("ap_millionths"))


@query(f"""WITH {AP}, c AS (SELECT candidate, label, count(truth_id) AS tp, count(*) AS np FROM m WHERE threshold = 0.5 GROUP BY ALL),
counted AS (SELECT coalesce(c.candidate, n.candidate) AS candidate, coalesce(c.label, n.label) AS label, CASE WHEN n_truths > 0 THEN coalesce(tp, 0) ELSE 0 END AS tp,
 CASE WHEN n_truths > 0 THEN coalesce(np - tp, 0) ELSE 0 END AS fp, coalesce(n_truths, 0) AS n_truths FROM c FULL JOIN n ON c.candidate = n.candidate AND c.label = n.label),
rated AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN n_truths > 0 THEN tp / n_truths ELSE 0 END AS recall FROM counted)
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM rated""")
def e03_class_metrics(t):
    return evaluate.class_metrics(t.predictions, t.truths, _matches(t)).select("candidate", "label", "tp", "fp", "n_truths", "precision", "recall", "f1")


@query(f"""WITH {AP}, c AS (SELECT m.candidate, count(m.truth_id) AS tp, count(*) AS np FROM m JOIN n ON n.candidate = m.candidate AND n.label = m.label WHERE threshold = 0.5 GROUP BY ALL),
s AS (SELECT candidate, count(*) AS n_truths FROM {{truths}} GROUP BY ALL)
SELECT s.candidate, coalesce(tp, 0) AS tp, coalesce(np - tp, 0) AS fp, s.n_truths, coalesce(tp / np::DOUBLE, 0) AS precision, coalesce(tp, 0) / s.n_truths::DOUBLE AS recall,
 round((SELECT avg(ap) FROM ap WHERE ap.candidate = s.candidate AND threshold = 0.5) * 1000000)::BIGINT AS map50_millionths
FROM s LEFT JOIN c USING (candidate)""")
def e04_evaluate(t):
    out = evaluate.evaluate(t.predictions, t.truths, (0.5, 0.75))
    return out.select("candidate", "tp", "fp", "n_truths", "precision", "recall", F.round(F.col("map50") * 1000000).cast("long").alias("map50_millionths"))


@query(f"""WITH {MATCHED} SELECT t1.candidate, count(*) AS small_truths, count(h.truth_id) AS small_found, count(h.truth_id) / count(*) AS small_recall FROM {{truths}} t1
LEFT JOIN (SELECT DISTINCT candidate, truth_id FROM m WHERE threshold = 0.5 AND truth_id IS NOT NULL) h ON h.candidate = t1.candidate AND h.truth_id = t1.truth_id
WHERE (x2 - x1) * (y2 - y1) < 0.0025 GROUP BY t1.candidate""")
def e05_small_recall(t):
    return evaluate.small_recall(t.truths, _matches(t)).select("candidate", "small_truths", "small_found", "small_recall")


@query(f"""WITH {AP}, c AS (SELECT m.candidate, count(m.truth_id) AS tp, count(*) AS np FROM m JOIN n ON n.candidate = m.candidate AND n.label = m.label WHERE threshold = 0.5 GROUP BY ALL),
s AS (SELECT candidate, count(*) AS n_truths FROM {{truths}} GROUP BY ALL), l AS (SELECT length(name) % 4 AS k, avg(coalesce(latency_ms, 1)) AS latency_ms FROM {{candidates}} GROUP BY k)
SELECT s.candidate, coalesce(tp, 0) AS tp, coalesce(np - tp, 0) AS fp, s.n_truths, coalesce(tp / np::DOUBLE, 0) AS precision, coalesce(tp, 0) / s.n_truths::DOUBLE AS recall,
 CASE WHEN coalesce(np, 0) > 0 THEN 1 - tp / np::DOUBLE ELSE 0 END AS fp_rate, round((SELECT avg(ap) FROM ap WHERE ap.candidate = s.candidate AND threshold = 0.5) * 1000000)::BIGINT AS map50_millionths,
 round((SELECT avg(ap) FROM ap WHERE ap.candidate = s.candidate) * 1000000)::BIGINT AS map_all_millionths, round(l.latency_ms * 1000)::BIGINT AS latency_us
FROM s LEFT JOIN c USING (candidate) LEFT JOIN l ON l.k = s.candidate::INT""")
def e08_benchmark(t):
    timings = t.candidates.select((F.length("name") % 4).cast("string").alias("candidate"), F.coalesce("latency_ms", F.lit(1.0)).alias("latency_ms"), F.lit(False).alias("warmup"))
    out = evaluate.benchmark(t.predictions, t.truths, timings, thresholds=(0.5, 0.75))
    return out.select("candidate", "tp", "fp", "n_truths", "precision", "recall", "fp_rate", *[F.round(F.col(c) * 1000000).cast("long").alias(f"{n}_millionths") for c, n in (("map50", "map50"), ("map50_95", "map_all"))], F.round(F.col("latency_ms") * 1000).cast("long").alias("latency_us"))


DOMINATED = """i AS (SELECT *, CASE WHEN latency_ms IS NULL OR latency_ms = 0 THEN 'inf'::DOUBLE ELSE latency_ms END AS l FROM {candidates}),
d AS (SELECT a.name, b.name AS other FROM i a JOIN i b ON a.name <> b.name AND b.map50 >= a.map50 AND b.recall >= a.recall AND b.l <= a.l AND (b.map50 > a.map50 OR b.recall > a.recall OR b.l < a.l))"""


@query(f"""WITH {DOMINATED} SELECT name, map50, recall, latency_ms FROM {{candidates}} WHERE name NOT IN (SELECT name FROM d)""")
def e09_pareto_frontier(t):
    return evaluate.pareto_frontier(t.candidates).select("name", "map50", "recall", "latency_ms")


@query(f"""WITH {DOMINATED} SELECT c.name, count(other) AS n, coalesce(string_agg(other, ',' ORDER BY other), '') AS dominated_by FROM {{candidates}} c
LEFT JOIN (SELECT * FROM d WHERE other NOT IN (SELECT name FROM d)) d ON d.name = c.name GROUP BY c.name""")
def j10_dominators(t):
    return evaluate.dominators(t.candidates).select("name", F.size("dominated_by").cast("long").alias("n"), F.array_join("dominated_by", ",").alias("dominated_by"))


@query(f"""WITH {DOMINATED} SELECT name, map50, name NOT IN (SELECT name FROM d) AS on_frontier, name = (SELECT min(name) FROM {{candidates}}) AS is_baseline FROM {{candidates}}""")
def e12_benchmark_view(t):
    first = t.candidates.agg(F.min("name")).first()[0]
    return evaluate.benchmark_view(t.candidates, first).select("name", "map50", "on_frontier", "is_baseline")


@query("""WITH b AS (SELECT recall AS br, map50 AS bm, fp_rate AS bf FROM {candidates} ORDER BY name LIMIT 1), n AS (SELECT min(name) AS name FROM {candidates}),
c AS (SELECT c.*, CASE WHEN c.name <> n.name THEN recall - br END AS dr, CASE WHEN c.name <> n.name THEN map50 - bm END AS dm, CASE WHEN c.name <> n.name THEN fp_rate - bf END AS df FROM {candidates} c, b, n),
r AS (SELECT name, 1 AS k, 'latency_ms' AS "check", latency_ms AS value, 20.0 AS bound, latency_ms IS NULL OR latency_ms <= 20 AS ok FROM c
 UNION ALL SELECT name, 2, 'cpu_percent', cpu_percent, 80, cpu_percent <= 80 FROM c WHERE cpu_percent IS NOT NULL
 UNION ALL SELECT name, 3, 'recall_delta', dr, -0.02, dr >= -0.02::DOUBLE FROM c WHERE dr IS NOT NULL UNION ALL SELECT name, 4, 'map50_delta', dm, -0.02, dm >= -0.02::DOUBLE FROM c WHERE dm IS NOT NULL
 UNION ALL SELECT name, 5, 'fp_rate_delta', df, 0.05, df <= 0.05::DOUBLE FROM c WHERE df IS NOT NULL)
SELECT name, k AS place, "check", value, bound::DOUBLE AS bound, ok, bool_and(ok) OVER (PARTITION BY name) AS passed FROM r""")
def e10_gate(t):
    first = t.candidates.agg(F.min("name")).first()[0]
    names = F.array(*[F.lit(n) for n in ("latency_ms", "cpu_percent", "recall_delta", "map50_delta", "fp_rate_delta")])
    out = evaluate.gate(t.candidates, first).select("name", "passed", F.explode("reasons").alias("r"))
    return out.select("name", F.array_position(names, F.col("r.check")).alias("place"), "r.check", "r.value", "r.bound", F.col("r.passed").alias("ok"), "passed")


@query("""WITH b AS (SELECT name, recall AS map50, map50 AS recall, CASE WHEN latency_ms > 20 THEN 'nan'::DOUBLE ELSE latency_ms * 2 END AS latency_ms FROM {candidates} WHERE cpu_percent IS NULL)
SELECT coalesce(a.name, b.name) AS name, a.map50 AS before_map50, b.map50 AS after_map50, round((b.map50 - a.map50) * 10000)::BIGINT AS delta, a.latency_ms AS before_ms, CASE WHEN isfinite(b.latency_ms) THEN b.latency_ms END AS after_ms
FROM {candidates} a FULL JOIN b ON a.name = b.name""")
def e11_before_after(t):
    later = F.when(F.col("latency_ms") > 20, F.lit(float("nan"))).otherwise(F.col("latency_ms") * 2)
    after = t.candidates.where("cpu_percent is null").select("name", F.col("recall").alias("map50"), F.col("map50").alias("recall"), later.alias("latency_ms"))
    out = pool.before_after(t.candidates, after)
    return out.select("name", "before_map50", "after_map50", F.round((F.col("after_map50") - F.col("before_map50")) * 10000).cast("long").alias("delta"), F.col("before_latency_ms").alias("before_ms"), F.col("after_latency_ms").alias("after_ms"))


@query("""SELECT model_name, version FROM (SELECT p_brand AS model_name, p_name AS version, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey DESC) AS n FROM {part}) WHERE n = 1""")
def w08_latest_deployment(t):
    rows = t.part.select(F.col("p_brand").alias("model_name"), F.col("p_name").alias("version"), F.col("p_size").alias("created_at"), F.col("p_partkey").alias("id"))
    return evaluate.latest_deployment(rows).select("model_name", "version")


@query("""WITH c AS (SELECT run, epoch, CASE WHEN isfinite(v) THEN v END AS v FROM (SELECT run, epoch, try_cast(nullif(map50, '') AS DOUBLE) AS v FROM {curves}))
SELECT run, max(v) AS best_map50, count(DISTINCT epoch) AS epochs, regexp_extract(run, '^(.*)-([^-]*)$', 1) AS model, regexp_extract(run, '^(.*)-([^-]*)$', 2) AS tag,
 first(v ORDER BY epoch DESC, v DESC) FILTER (v IS NOT NULL) AS latest_map50, first(epoch ORDER BY v DESC, epoch) FILTER (v IS NOT NULL) AS best_epoch, bool_or(epoch > 40) AS has_weights FROM c GROUP BY run""")
def a09_training_index(t):
    """Runs that reached their fortieth epoch have weights."""
    return pool.training_index(pool.curve_cells(t.curves, ["map50"]), t.curves.where("epoch > 40").select("run"))


# --- reconciliation

DECIDED = """g AS (SELECT object_id, feed_label, seg_class, seg_area, CASE WHEN lower(trim(seg_class)) IN ('person', 'car', 'dog', 'cat') THEN seg_class ELSE '' END AS sc FROM {segments}),
v AS (SELECT *, CASE WHEN lower(trim(vlm_label)) = 'human' THEN 'person' WHEN lower(trim(vlm_label)) IN ('person', 'car', 'dog', 'cat') THEN lower(trim(vlm_label)) ELSE '' END AS vc FROM {verdicts}),
k AS (SELECT g.*, covers, vlm_label, vlm_error, vc, coalesce(trim(seg_class) <> '' AND seg_area > 0, false) AS ok FROM g JOIN v USING (object_id)),
d AS (SELECT object_id, feed_label, seg_class, ok, CASE WHEN NOT ok THEN 'DROP' WHEN covers IS NULL THEN CASE WHEN vlm_error = 'transport' THEN 'PENDING' ELSE 'DROP' END
        WHEN trim(vlm_label) = '' OR NOT covers OR vc = '' OR vc <> sc THEN 'DROP' ELSE 'KEEP' END AS status,
      CASE WHEN NOT ok THEN 'sam_failure' WHEN covers IS NULL THEN CASE WHEN vlm_error = 'malformed' THEN 'vlm_malformed' ELSE 'vlm_failure' END
        WHEN trim(vlm_label) = '' OR NOT covers OR vc = '' OR vc <> sc THEN 'vlm_conditions' END AS reason,
      ok AND covers IS NOT NULL AND trim(vlm_label) = '' AS absent FROM k),
o AS (SELECT d.object_id, feed_label, CASE WHEN ok THEN seg_class END AS sam_class, coalesce(w.status, d.status) AS status, d.status AS pipeline_status,
        CASE WHEN w.status IS NULL THEN reason WHEN w.status = 'DROP' THEN 'human_override' END AS reason
      FROM d LEFT JOIN (SELECT * FROM {overrides} WHERE status IN ('KEEP', 'DROP')) w USING (object_id))"""


def _decisions(t: Tables) -> DataFrame:
    segments = t.segments.withColumn("seg_box", boxes.box("x1", "y1", "x2", "y2"))
    return reconcile.decide(t.segments.select("object_id", "feed_label"), segments, t.verdicts, ["person", "car", "dog", "cat"])


@query(f"""WITH {DECIDED} SELECT object_id, status, reason FROM d""")
def x05_decide(t):
    return _decisions(t).select("object_id", "status", "reason")


@query(f"""WITH {DECIDED} SELECT object_id, status, pipeline_status, reason FROM o""")
def x06_overrides(t):
    return reconcile.apply_overrides(_decisions(t), t.overrides).select("object_id", "status", "pipeline_status", "reason")


STATS = DECIDED + """, s AS (SELECT CASE WHEN feed_label = '' THEN 'unknown' ELSE feed_label END AS label, grouping(CASE WHEN feed_label = '' THEN 'unknown' ELSE feed_label END) AS overall, count(*) AS processed,
 count(*) FILTER (status = 'KEEP') AS accepted, count(*) FILTER (status = 'DROP') AS dropped, count(*) FILTER (status = 'PENDING') AS pending,
 count(*) FILTER (status <> 'DROP' OR sam_class <> '') AS sam_ok, count(*) FILTER (status = 'DROP' AND reason = 'sam_failure') AS sam_fail,
 count(*) FILTER (status = 'KEEP' OR (status = 'DROP' AND reason = 'vlm_conditions')) AS vlm_calls,
 count(*) FILTER (status = 'DROP' AND reason IN ('vlm_failure', 'vlm_malformed')) AS vlm_fail FROM o GROUP BY ROLLUP (CASE WHEN feed_label = '' THEN 'unknown' ELSE feed_label END))"""


def _statistics(t: Tables) -> DataFrame:
    return reconcile.audit_statistics(reconcile.apply_overrides(_decisions(t), t.overrides))


@query(f"""WITH {STATS} SELECT label, overall::INT AS overall, processed, accepted, dropped, pending, sam_ok, sam_fail, vlm_calls, vlm_fail, pending AS vlm_transport,
 round(accepted / processed, 4) AS acceptance_rate FROM s""")
def x08_audit_statistics(t):
    return _statistics(t).withColumn("overall", F.col("overall").cast("int"))


@query(f"""WITH {STATS}, f AS (SELECT processed, unnest([0, 1, 2, 3]) AS step, unnest(['candidates', 'segment_ok', 'vlm_parsed', 'kept']) AS stage, unnest([processed, sam_ok, vlm_calls + vlm_fail, accepted]) AS n FROM s WHERE overall = 1)
SELECT step, stage, n, 100 * n / processed AS percent FROM f""")
def x15_funnel(t):
    return reconcile.funnel(_statistics(t))


@query(f"""WITH {STATS} SELECT label, processed, accepted / processed::DOUBLE AS accepted_share, dropped / processed::DOUBLE AS dropped_share, pending / processed::DOUBLE AS pending_share FROM s WHERE overall = 0""")
def x16_class_bars(t):
    return reconcile.class_bars(_statistics(t))


@query(f"""WITH {DECIDED} SELECT object_id FROM d WHERE status = 'DROP' AND absent""")
def x10_hard_negatives(t):
    return reconcile.hard_negatives(_decisions(t)).select("object_id")


@query(f"""WITH {DECIDED} SELECT sample_id AS frame_key, string_agg(object_id, ',' ORDER BY object_id) AS ids FROM (SELECT d.object_id, sample_id FROM d JOIN {{segments}} USING (object_id) WHERE status = 'KEEP') GROUP BY sample_id""")
def x12_frame_export(t):
    keyed = _decisions(t).join(t.segments.select("object_id", F.col("sample_id").alias("frame_key")), "object_id").withColumn("label_line", F.col("feed_label"))
    return reconcile.frame_export(keyed).select("frame_key", F.array_join("object_ids", ",").alias("ids"))


@query(f"""WITH {DECIDED} SELECT object_id FROM d WHERE NOT (status IN ('KEEP', 'DROP') AND coalesce(reason, '') <> 'sam_failure')""")
def j12_unresolved(t):
    keys = {"sample_hash": F.md5("object_id"), "sam_key": F.lit("s"), "vlm_key": F.lit("v"), "pipeline_version": F.lit("1")}
    cached = _decisions(t).withColumns({**keys, "error_kind": F.lit("import"), "has_covers": F.lit(True), "has_class_label": F.lit(True)})
    return reconcile.unresolved(t.segments.select("object_id").withColumns(keys), cached).select("object_id")


@query(f"""WITH {DECIDED} SELECT object_id FROM d WHERE NOT (status IN ('KEEP', 'DROP') AND coalesce(reason, '') <> 'sam_failure' AND regexp_matches(object_id, '[123]$'))""")
def j12_stale_verdicts(t):
    """As ``j12_unresolved``, with verdicts that lack both blind fields: those are asked for again, unless the segmenter failed."""
    keys = {"sample_hash": F.md5("object_id"), "sam_key": F.lit("s"), "vlm_key": F.lit("v"), "pipeline_version": F.lit("1")}
    ends = lambda n: F.col("object_id").endswith(n)
    cached = _decisions(t).withColumns({**keys, "error_kind": F.lit("import"), "has_covers": ends("1"), "has_class_label": F.when(~ends("4"), ends("2")), "vlm_error": F.when(ends("3"), "sam")})
    return reconcile.unresolved(t.segments.select("object_id").withColumns(keys), cached).select("object_id")


# --- functions as table jobs


@query(f"""WITH p AS (SELECT a.id AS a, b.id AS b, a.x1 AS ax1, {IOU.format(a="a", b="b")} AS iou FROM (SELECT * FROM {{annotations}} WHERE {PROPER}) a JOIN (SELECT * FROM {{annotations}} WHERE {PROPER}) b ON a.sample_id = b.sample_id AND a.id < b.id)
SELECT a, b, iou FROM p WHERE iou > 0""")
def p02_box_pair_metrics(t):
    own = t.annotations.where(boxes.is_valid(boxes.box("x1", "y1", "x2", "y2")))
    a = own.select("sample_id", F.col("id").alias("a"), boxes.box("x1", "y1", "x2", "y2").alias("p"))
    b = own.select("sample_id", F.col("id").alias("b"), boxes.box("x1", "y1", "x2", "y2").alias("q"))
    return a.join(b, "sample_id").where("a < b").select("a", "b", boxes.iou(F.col("p"), F.col("q")).alias("iou")).where("iou > 0")


@query("""WITH d AS (SELECT id, x1, y1, x2, y2, ascii(substr(source, 1, 1)) % 3 AS f, verified = 1 AS norm, length(id) % 2 = 0 AS whole FROM {annotations}),
p AS (SELECT *, CASE WHEN x1 IS NULL OR y1 IS NULL OR x2 IS NULL OR y2 IS NULL THEN 'bad_bbox' END AS bad, CASE WHEN norm THEN CASE WHEN whole THEN 1000 ELSE 2000 END ELSE 1000 END AS sx, CASE WHEN norm THEN CASE WHEN whole THEN 500 ELSE 1000 END ELSE 500 END AS sy,
 CASE WHEN whole THEN 0 ELSE 100 END AS ox FROM d),
b AS (SELECT id, bad, greatest(0, least(1000, x1 * sx - ox)) AS a1, greatest(0, least(500, y1 * sy - ox)) AS b1, greatest(0, least(1000, x2 * sx - ox)) AS a2, greatest(0, least(500, y2 * sy - ox)) AS b2 FROM p),
o AS (SELECT *, bad IS NULL AND a2 > a1 AND b2 > b1 AS ok FROM b)
SELECT id, CASE WHEN bad IS NOT NULL THEN bad WHEN NOT ok THEN 'empty_box' END AS reason, CASE WHEN ok THEN round(a1 * 1000)::BIGINT END AS x1, CASE WHEN ok THEN round(b1 * 1000)::BIGINT END AS y1,
 CASE WHEN ok THEN round(a2 * 1000)::BIGINT END AS x2, CASE WHEN ok THEN round(b2 * 1000)::BIGINT END AS y2 FROM o""")
def p01_normalize_boxes(t):
    norm, kind = F.col("verified") == 1, F.ascii("source") % 3
    unit = boxes.box("x1", "y1", "x2", "y2")
    px = boxes.box(F.col("x1") * 1000, F.col("y1") * 500, F.col("x2") * 1000, F.col("y2") * 500)
    b = F.when(norm, unit).otherwise(px)
    raw = F.when(kind == 0, F.array(*[b[k] for k in ("x1", "y1", "x2", "y2")])).when(kind == 1, boxes.to_xywh(b)).otherwise(boxes.to_cxcywh(b))
    space = F.when(F.length("id") % 2 == 0, "image").otherwise("frame")
    fmt = F.when(kind == 0, "xyxy").when(kind == 1, "xywh").otherwise("cxcywh")
    origin, frame = F.struct(F.lit(100.0).alias("x"), F.lit(100.0).alias("y")), F.struct(F.lit(2000.0).alias("w"), F.lit(1000.0).alias("h"))
    d = t.annotations.select("id", raw.alias("raw"), fmt.alias("fmt"), norm.alias("norm"), space.alias("space"))
    out, reason = boxes.declared_box(F.col("raw"), F.col("fmt"), F.col("norm"), F.col("space"), 1000.0, 500.0, origin, frame)
    d = d.select("id", out.alias("box"), reason.alias("reason"))
    return d.select("id", "reason", *[F.round(F.col("box")[k] * 1000).cast("long").alias(k) for k in ("x1", "y1", "x2", "y2")])


def _mask(x0, x1):
    """A mask of 100 runs that k shifts. k is bound once for a mask: Spark moves the text of its view into the function, which every run would compute again."""
    return boxes.let(F.col("k") % 7, lambda shift: F.transform(F.sequence(F.lit(0), F.lit(99)), lambda y: F.struct(y.alias("y"), x0(shift).cast("int").alias("x0"), x1(shift).cast("int").alias("x1"))))


@query("""SELECT object_id, (100 * (30 + k % 7))::BIGINT AS mask_area, x1 * 100 AS fx, 10.0::DOUBLE AS tx1, (40 + k % 7)::DOUBLE AS tx2 FROM (SELECT object_id, k, x1 FROM {segments})""")
def p03_object_geometry(t):
    runs = _mask(lambda shift: F.lit(10), lambda shift: 40 + shift)
    d = t.segments.withColumn("runs", runs)
    box = boxes.tight_box(F.col("runs"))
    return d.select("object_id", boxes.mask_area(F.col("runs")).alias("mask_area"), (F.col("x1") * 100).alias("fx"), box["x1"].alias("tx1"), box["x2"].alias("tx2"))


@query("""SELECT id, label, CASE WHEN word IN ('person', 'people', 'human', 'man', 'woman', 'pedestrian') THEN 'person' WHEN word IN ('car', 'sedan', 'automobile', 'suv', 'pickup') THEN 'car' ELSE '' END AS name
FROM (SELECT id, label, lower(trim(label)) AS word FROM (SELECT id, CASE source WHEN 'vlm' THEN concat(' ', upper(label)) WHEN 'human' THEN replace(label, 'person', 'Human ') WHEN 'external' THEN replace(label, 'car', 'Suv') ELSE label END AS label FROM {annotations}))""")
def p04_canonicalize_labels(t):
    said = F.when(F.col("source") == "vlm", F.concat(F.lit(" "), F.upper("label"))).when(F.col("source") == "human", F.replace("label", F.lit("person"), F.lit("Human "))).when(F.col("source") == "external", F.replace("label", F.lit("car"), F.lit("Suv"))).otherwise(F.col("label"))
    return t.annotations.select("id", said.alias("label")).select("id", "label", labels.canonical_label(F.col("label"), ["person", "car"]).alias("name"))


@query("""SELECT label, row_number() OVER (ORDER BY f, label) - 1 AS class_id FROM (SELECT label, min(id) AS f FROM {annotations} WHERE label <> '' GROUP BY label)""")
def l06_vocabulary(t):
    return labels.vocabulary_of(t.annotations.where("label <> ''"), "label", "id")


X1 = """try_cast(regexp_extract(content, 'bbox": \\[([0-9.]+)', 1) AS DOUBLE)"""
X2 = """try_cast(regexp_extract(content, '0\\.2, ([0-9.]+)', 1) AS DOUBLE)"""


@query(f"""WITH e AS (SELECT id, content, {X1} AS x1, {X2} AS x2, CASE WHEN content IS NULL THEN 'transport' WHEN content NOT LIKE '%{{{{%' THEN 'rejected' WHEN content LIKE '%"name"%' OR content LIKE '%"confidence": 7%' THEN 'rejected'
 WHEN x2 <= x1 THEN 'rejected' ELSE 'ok' END AS status FROM {{responses}})
SELECT id, status, CASE WHEN status = 'ok' THEN regexp_extract(content, '"label": "(\\w+)"', 1) END AS label, CASE WHEN status = 'ok' THEN try_cast(regexp_extract(content, 'confidence": ([0-9.]+)', 1) AS DOUBLE) END AS confidence,
 CASE WHEN status = 'ok' THEN x1 END AS x1, CASE WHEN status = 'ok' THEN 0.2 END AS y1, CASE WHEN status = 'ok' THEN x2 END AS x2, CASE WHEN status = 'ok' THEN 0.9 END AS y2, CASE WHEN status = 'ok' THEN 1 END AS n FROM e""")
def p05_parse_model_output(t):
    """A response here holds one object; it is returned whole, with their number."""
    found = scoring.parse_detections(t.responses)
    return found.select("id", "status", F.get("objects", F.lit(0)).alias("o"), F.size("objects").alias("n")).select("id", "status", "o.*", F.when(F.col("status") == "ok", F.col("n")).alias("n"))


@query("""SELECT id, strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y%m%d') AS day, ts AS seconds FROM {samples}""")
def p06_normalize_times(t):
    mixed = F.when(F.col("verified") == 1, F.concat("created_at", F.lit("Z"))).otherwise(F.col("ts").cast("string"))
    s = times.unix_seconds(mixed)
    return t.samples.select("id", times.day_key(s).alias("day"), s.alias("seconds"))


@query("""SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN h < 5 THEN 'night' WHEN h < 9 THEN 'dawn' WHEN h < 17 THEN 'day' WHEN h < 21 THEN 'dusk' ELSE 'night' END AS bucket
FROM (SELECT (start_time // 3600) % 24 AS h FROM {motion})) GROUP BY bucket""")
def t04_time_buckets(t):
    return t.motion.groupBy(times.time_bucket(F.col("start_time").cast("double")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT *, end_time - start_time AS span, least(5, floor((end_time - start_time) / 10) + 1)::INT AS n FROM {event_feed} WHERE end_time IS NOT NULL),
f AS (SELECT *, CASE WHEN span <= 0 OR n <= 1 THEN 1 ELSE n END AS k FROM c),
g AS (SELECT *, unnest(range(0, k))::INT AS frame_index FROM f),
h AS (SELECT *, CASE WHEN frame_index = 0 THEN start_time WHEN frame_index = k - 1 THEN end_time ELSE round(start_time + span * (frame_index / (k - 1)::DOUBLE), 3) END AS moment FROM g)
SELECT id, frame_index, CASE WHEN moment <> start_time THEN round(moment * 1000)::BIGINT END AS frame_ms FROM h""")
def p07_plan_frames(t):
    return feeds.plan_frames(t.event_feed, 5, 10.0).select("id", "frame_index", F.round(F.col("frame_ts") * 1000).cast("long").alias("frame_ms"))


@query("""SELECT event_id FROM (SELECT unnest(detections) AS event_id FROM {reviews}) GROUP BY event_id""")
def s06_event_ids(t):
    return feeds.event_ids(t.reviews, "detections").select("event_id")


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY severity ORDER BY start_time DESC, id) AS r FROM {reviews} WHERE camera IN ('cam1', 'cam2', 'cam3')),
f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE severity WHEN 'alert' THEN 1 ELSE 2 END, start_time DESC, camera) AS q FROM n WHERE r <= 300)
SELECT id, severity, start_time FROM f WHERE q = 1""")
def s04_list_reviews(t):
    return feeds.list_reviews(t.reviews, cameras=["cam1", "cam2", "cam3"], limit=300).select("id", "severity", "start_time")


@query("""SELECT id, start_time FROM {event_feed} WHERE label = 'person' ORDER BY start_time DESC, id LIMIT 100""")
def s05_list_events(t):
    return feeds.list_events(t.event_feed, labels=["person"], limit=100).select("id", "start_time")


# --- ledgers


@query("""SELECT id, camera, CASE WHEN camera = 'cam5' THEN 'useful' ELSE quality END AS quality FROM {samples}""")
def m01_set_quality(t):
    out, _ = ledger.set_quality(t.samples, pool.triage_batch(t.samples, t.annotations, cameras=["cam5"]), "useful")
    return out.select("id", "camera", "quality")


def _stored(t: Tables, name: str, by: str, column) -> store.Store:
    """A view as a copy-on-write table in a new folder."""
    out = store.Store(t.spark, _folders(t, name)[0], by)
    out.create(getattr(t, name).withColumn(by, column))
    return out


def _month():
    return F.substring("created_at", 1, 7)


@query("""SELECT id, camera, CASE WHEN image_path LIKE '%7.jpg' THEN 'bad' ELSE quality END AS quality, substr(created_at, 1, 7) AS month, 2 AS version FROM {samples}""")
def m01_stored_quality(t):
    """Samples by month; a verdict is set for a batch, which rewrites the batch's months only."""
    samples = _stored(t, "samples", "month", _month())
    ledger.set_quality_stored(samples, t.samples.where("image_path like '%7.jpg'"), "bad")
    ledger.set_quality_stored(samples, t.samples.where("image_path like '%7.jpg'"), "bad")  # nothing is left to write
    return samples.read().select("id", "camera", "quality", "month", F.lit(samples.version()).alias("version"))


@query("""WITH r AS (SELECT id FROM {samples} WHERE camera IN ('cam3', 'cam4'))
SELECT id, sample_id, source, label, verified, substr(created_at, 1, 7) AS month FROM {annotations} WHERE NOT (source = 'vlm' AND sample_id IN (SELECT id FROM r))
UNION ALL SELECT concat(id, '-vlm-2030-01-01T00:00:00-', n), id, 'vlm', CASE n WHEN 0 THEN 'car' ELSE 'dog' END, 1, '2030-01' FROM r, (SELECT unnest([0, 1]) AS n)
UNION ALL SELECT id, NULL, status, camera, CASE WHEN camera IN ('cam3', 'cam4') THEN 1 ELSE verified END, substr(created_at, 1, 7) FROM {samples}""")
def m02_stored_verified(t):
    """Verification results replace earlier ones of their samples; both tables are read back whole."""
    samples, annotations = _stored(t, "samples", "month", _month()), _stored(t, "annotations", "month", _month())
    box = [F.lit(v).alias(n) for n, v in (("x1", 0.1), ("y1", 0.1), ("x2", 0.2), ("y2", 0.2), ("confidence", 0.9))]
    results = t.samples.where("camera in ('cam3', 'cam4')").select(F.col("id").alias("sample_id"), F.array(*[F.struct(F.lit(x).alias("label"), *box) for x in ("car", "dog")]).alias("objects"))
    for _ in range(2):
        ledger.store_verified_stored(samples, annotations, results, None, "replace", "2030-01-01T00:00:00", _month())
    rows = annotations.read().select("id", "sample_id", "source", "label", "verified", "month")
    return rows.union(samples.read().select("id", F.lit(None).cast("string"), "status", "camera", "verified", "month"))


@query("""SELECT id, event_id, 'annotation' AS kind, label, substr(created_at, 1, 7) AS month FROM {annotations} WHERE NOT event_id LIKE '%7'
UNION ALL SELECT id, event_id, 'sample', camera, substr(created_at, 1, 7) FROM {samples} WHERE NOT event_id LIKE '%7'""")
def m04_stored_delete(t):
    """Samples and annotations by month; events are deleted from both, and both are read back whole."""
    samples, annotations = _stored(t, "samples", "month", _month()), _stored(t, "annotations", "month", _month())
    ledger.delete_events_stored(samples, annotations, t.samples.where("event_id like '%7'"))
    left = annotations.read().select("id", "event_id", F.lit("annotation").alias("kind"), "label", "month")
    return left.union(samples.read().select("id", "event_id", F.lit("sample"), "camera", "month"))


@query("""SELECT object_id, status, CASE WHEN object_id LIKE '%1' THEN '3' ELSE '2' END AS updated_at FROM {overrides} WHERE status IN ('KEEP', 'DROP')""")
def m08_stored_overrides(t):
    """Overrides in buckets of their object; newer ones replace the older of their buckets."""
    rows = t.overrides.where("status in ('KEEP', 'DROP')").withColumn("updated_at", F.lit("2"))
    bucket = F.pmod(F.xxhash64("object_id"), F.lit(16)).cast("string")
    out = store.Store(t.spark, _folders(t, "overrides")[0], "bucket")
    out.create(rows.withColumns({"status": F.when(F.col("object_id").like("%1"), "DROP").otherwise(F.col("status")), "bucket": bucket}))
    changes = t.overrides.where("object_id like '%1'").withColumn("updated_at", F.lit("3"))
    ledger.upsert_overrides_stored(out, changes, bucket)
    return out.read().select("object_id", "status", "updated_at")


@query("""SELECT 'annotation' AS what, id FROM {annotations} WHERE NOT event_id LIKE '%7' UNION ALL SELECT 'sample', id FROM {samples} WHERE NOT event_id LIKE '%7'""")
def m04_delete_events(t):
    s, a = ledger.delete_events(t.samples, t.annotations, t.samples.where("event_id like '%7'").union(t.samples.where("event_id like '%7'")))
    return a.select(F.lit("annotation").alias("what"), "id").union(s.select(F.lit("sample"), "id"))


@query("""SELECT object_id, status FROM {overrides} WHERE status IN ('KEEP', 'DROP')""")
def m08_upsert_overrides(t):
    changes = t.overrides.withColumn("updated_at", F.lit("2"))
    old = changes.where("status = 'KEEP'").withColumns({"status": F.lit("DROP"), "updated_at": F.lit("1")})
    return ledger.upsert_overrides(old, changes)[0].select("object_id", "status")


STATUS = """CASE WHEN content IS NULL THEN 'transport' WHEN content NOT LIKE '%{{%' THEN 'rejected' WHEN content LIKE '%"name"%' OR content LIKE '%"confidence": 7%' THEN 'rejected'
 WHEN regexp_extract(content, '0\\.2, ([0-9.]+)', 1)::DOUBLE <= regexp_extract(content, 'bbox": \\[([0-9.]+)', 1)::DOUBLE THEN 'rejected' ELSE 'ok' END"""


@query(f"""WITH s AS (SELECT {STATUS} AS status FROM {{responses}}) SELECT count(*) AS processed, count(*) FILTER (status = 'ok') AS annotated, 0 AS skipped, count(*) FILTER (status = 'transport') AS failed,
 count(*) FILTER (status = 'rejected') AS dropped, count(*) FILTER (status = 'ok') AS objects FROM s""")
def a12_verify_summary(t):
    return ledger.verify_summary(scoring.parse_detections(t.responses).withColumn("sample_id", F.col("id")))


# --- more rows of the inventory


def _coco(t: Tables) -> DataFrame:
    """Orders as images and line items as objects, in the layout of COCO files."""
    o = t.orders.select(F.array(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("file_name"), F.lit(100).alias("width"), F.lit(100).alias("height"))).alias("images"))
    a = t.lineitem.select(F.array(F.struct(F.monotonically_increasing_id().alias("id"), F.col("l_orderkey").alias("image_id"), F.ascii("l_returnflag").cast("long").alias("category_id"), F.array(F.col("l_linenumber").cast("double"), F.lit(1.0), F.lit(9.0), F.lit(9.0)).alias("bbox"), F.lit(0.5).alias("score"))).alias("annotations"))
    c = t.spark.sql("SELECT array(struct(65L AS id, 'human' AS name), struct(78L AS id, 'car' AS name), struct(82L AS id, 'tree' AS name)) AS categories")
    return o.unionByName(a, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


@query("""SELECT id, camera, severity, floor(start_time) AS start_time, '' AS thumb_path FROM {reviews}""")
def s01_review_feed(t):
    raw = t.reviews.select(F.concat(F.lit('{"id": "'), "id", F.lit('", "camera": "'), "camera", F.lit('", "start_time": '), F.col("start_time").cast("long").cast("string"), F.when(F.col("severity") == "alert", ', "severity": "alert"').otherwise(""), F.lit("}")).alias("j"))
    parsed = raw.select(F.from_json("j", "id string, camera string, severity string, thumb_path string, start_time string, end_time string, data variant, zones array<string>").alias("r")).select("r.*")
    return feeds.parse_reviews(parsed).select("id", "camera", "severity", "start_time", "thumb_path")


@query("""SELECT id, label, box[1] AS x1, box[2] AS y1, box[1] + box[3] AS x2, end_time IS NOT NULL AS completed FROM {event_feed}""")
def s02_event_feed(t):
    raw = t.event_feed.select("id", "camera", "label", F.col("start_time").cast("string").alias("start_time"), F.col("end_time").cast("string").alias("end_time"), "box")
    missing = {"top_score": "string", "score": "string", "false_positive": "boolean", "zones": "array<string>", "has_clip": "boolean", "has_snapshot": "boolean", "sub_label": "string", "plus_id": "string", "data": "string"}
    out = feeds.parse_events(raw.withColumns({k: F.lit(None).cast(v) for k, v in missing.items()}))
    return out.select("id", "label", "box.x1", "box.y1", "box.x2", "completed")


@query("""SELECT camera, start_time, CASE WHEN motion > 0.9 THEN 0 ELSE motion END AS motion FROM {motion} WHERE start_time % 5 <> 0""")
def s03_motion_feed(t):
    raw = t.motion.select("camera", F.when(F.col("start_time") % 5 != 0, F.concat(F.col("start_time").cast("string"), F.lit(".7"))).alias("start_time"), F.when(F.col("motion") <= 0.9, F.col("motion").cast("string")).alias("motion"))
    return feeds.parse_motion(raw)


@query("""SELECT concat('external-', l_orderkey::VARCHAR) AS sample_id, CASE l_returnflag WHEN 'A' THEN 'person' ELSE 'car' END AS label, l_linenumber / 100 AS x1, 0.01 AS y1,
 (l_linenumber + 9) / 100 AS x2, 0.1 AS y2, 0.5 AS confidence, 1 AS verified FROM {lineitem} WHERE l_returnflag IN ('A', 'N')
UNION ALL SELECT concat('external-', l_orderkey::VARCHAR), '(sample)', NULL, NULL, NULL, NULL, NULL, 0 FROM {lineitem} WHERE l_returnflag IN ('A', 'N') GROUP BY l_orderkey""")
def s07_coco_import(t):
    from ..sources import files

    samples, annotations, _ = files.import_coco(_coco(t), ["person", "car"], {"human": "person"})
    nothing = [F.lit(None).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2", "confidence")]
    return annotations.select("sample_id", "label", "x1", "y1", "x2", "y2", "confidence", "verified").union(samples.select("id", F.lit("(sample)"), *nothing, "verified"))


@query("""SELECT count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid FROM (SELECT l_partkey % 3 <> 0 AND l_linenumber <= 4 AND l_suppkey % 11 <> 0 AS ok FROM {lineitem})""")
def s11_label_lines(t):
    from ..sources import files

    line = F.concat_ws(" ", F.col("l_linenumber").cast("string"), F.when(F.col("l_partkey") % 3 == 0, "1.5").otherwise("0.5"), F.lit("0.5 0.2"), F.when(F.col("l_suppkey") % 11 == 0, "0").otherwise("0.2"))
    parsed = files.parse_labels(t.lineitem.select(F.lit("f").alias("file"), F.lit(0).alias("line_no"), line.alias("value")), 5)
    return parsed.agg(F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"))


@query("""SELECT o_orderkey::VARCHAR AS sample_id, CASE WHEN o_orderkey % 7 = 0 THEN 'duplicate_id' END AS reason FROM {orders}""")
def s13_manifest_append(t):
    from ..sources import files

    rows = t.orders.select(F.col("o_orderkey").cast("string").alias("sample_id"))
    good, bad = files.append_manifest(rows.where("sample_id % 7 = 0"), rows)
    return good.withColumn("reason", F.lit(None).cast("string")).union(bad)


@query(f"""WITH {DECIDED} SELECT sample_id AS frame_key, concat(repeat(concat('0 0.5 0.5 0.1 0.1', chr(10)), count(*) - 1), '0 0.5 0.5 0.1 0.1') AS body
FROM (SELECT sample_id FROM d JOIN {{segments}} USING (object_id) WHERE d.status = 'KEEP' AND object_id NOT LIKE '%-1') GROUP BY sample_id""")
def s20_export_new(t):
    from ..sources import files

    kept = _decisions(t).where("status = 'KEEP'").select("object_id", F.lit("0 0.5 0.5 0.1 0.1").alias("label_line")).join(t.segments.select("object_id", F.col("sample_id").alias("frame_key")), "object_id")
    bodies, _ = files.export_new(kept, kept.where("object_id like '%-1'"))
    return bodies.select("frame_key", "body")


@query("""SELECT id, bit_count(xor(a, b))::INT AS distance FROM (SELECT o_orderkey AS id, o_custkey * 7919 AS a, o_orderkey * 104729 AS b FROM {orders})""")
def h02_hamming(t):
    a, b = F.bin(F.col("o_custkey") * 7919), F.bin(F.col("o_orderkey") * 104729)
    return t.orders.select(F.col("o_orderkey").alias("id"), hashes.hamming(a, b).alias("distance"))


@query("""SELECT id, sha256(concat('img:', image_path, '|class:', coalesce(feed_label, ''), '|pipeline:1')) AS sample_hash FROM {samples}""")
def h07_sample_hash(t):
    return t.samples.select("id", hashes.sample_hash(img=F.col("image_path"), **{"class": F.col("feed_label")}, pipeline=F.lit("1")).alias("sample_hash"))


@query("""SELECT label, class_id, count(*) AS n FROM (SELECT label, CASE label WHEN 'person' THEN 0 WHEN 'car' THEN 2 WHEN 'dog' THEN 16 END AS class_id FROM {annotations}) GROUP BY ALL""")
def l02_class_index(t):
    return t.annotations.select("label", labels.class_index(F.col("label")).alias("class_id")).groupBy("label", "class_id").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT new_id, count(*) AS n FROM (SELECT CASE l_linenumber % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS new_id FROM {lineitem}) WHERE new_id IS NOT NULL GROUP BY new_id""")
def l04_remap_classes(t):
    names = labels.class_table(t.spark, ["car", "person", "tree"])
    mapped = labels.remap_classes(t.lineitem.select((F.col("l_linenumber") % 3).alias("class_id")), names, labels.class_table(t.spark, ["person", "car"]))
    return mapped.groupBy(F.col("class_id").alias("new_id")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT run, regexp_extract(run, '^(.*)-([^-]*)$', 1) AS model, regexp_extract(run, '^(.*)-([^-]*)$', 2) AS tag FROM (SELECT DISTINCT run FROM {curves})""")
def l12_run_names(t):
    n = labels.run_name(F.col("run"))
    return t.curves.select("run").distinct().select("run", n["model"].alias("model"), n["tag"].alias("tag"))


@query("""SELECT run, count(v) AS known FROM (SELECT run, CASE WHEN isfinite(try_cast(nullif(map50, '') AS DOUBLE)) THEN 1 END AS v FROM {curves}) GROUP BY run""")
def s17_curve_cells(t):
    return pool.curve_cells(t.curves, ["map50"]).groupBy("run").agg(F.count("map50").alias("known"))


@query("""SELECT name, CASE WHEN name <> (SELECT min(name) FROM {candidates}) THEN (SELECT map50 FROM {candidates} ORDER BY name LIMIT 1) END AS base_map50 FROM {candidates}""")
def j09_with_baseline(t):
    return evaluate.with_baseline(t.candidates, t.candidates.agg(F.min("name")).first()[0]).select("name", "base_map50")


@query("""SELECT count(*) FILTER (hit) AS reused, count(*) FILTER (NOT hit) AS to_score FROM (SELECT k % 3 = 0 AS hit FROM {segments})""")
def j13_reuse_results(t):
    objects = t.segments.select("object_id", F.md5("object_id").alias("sample_hash"), F.lit("m1").alias("sam_key"))
    cache = t.segments.where("k % 3 <> 1").select("object_id", F.md5("object_id").alias("sample_hash"), F.when(F.col("k") % 3 == 0, "m1").otherwise("m0").alias("sam_key"), F.lit(1).alias("result"))
    done, todo = reconcile.reuse_results(objects, cache, "sam_key")
    return done.agg(F.count(F.lit(1)).alias("reused")).crossJoin(todo.agg(F.count(F.lit(1)).alias("to_score")))


@query(f"""WITH {DECIDED} SELECT object_id FROM d WHERE status = 'DROP' AND feed_label = 'car'""")
def f08_decision_index(t):
    return reconcile.decision_index(_decisions(t), "DROP", "car").select("object_id")


@query("""SELECT object_id FROM {segments} WHERE feed_label IN ('person', 'dog') AND k % 5 <> 0 ORDER BY object_id LIMIT 200""")
def f09_objects_to_audit(t):
    return reconcile.objects_to_audit(t.segments, ["person", "dog"], t.segments.where("k % 5 = 0"), 200).select("object_id")


@query("""SELECT object_id, image_path FROM {segments} s JOIN {samples} m ON m.id = s.sample_id WHERE s.feed_label IN ('person', 'dog') AND k % 5 <> 0 AND image_path NOT LIKE '%3.jpg' AND image_path NOT LIKE '%4.jpg'""")
def f09_decodable_objects(t):
    """Objects whose image is listed (not those that end in 4) and can be decoded (not those that end in 3)."""
    objects = t.segments.join(t.samples.select(F.col("id").alias("sample_id"), "image_path").hint("merge"), "sample_id")
    images = t.samples.where("image_path not like '%4.jpg'").select("image_path", (~F.col("image_path").like("%3.jpg")).alias("decodable")).distinct()
    return reconcile.objects_to_audit(objects, ["person", "dog"], t.segments.where("k % 5 = 0"), images=images).select("object_id", "image_path")


@query(f"""WITH {DECIDED} SELECT count(*) AS n, count(*) FILTER (k.ok AND covers AND trim(vlm_label) <> '' AND vc <> '' AND vc = sc) AS training FROM k""")
def x04_training_samples(t):
    j = t.segments.join(t.verdicts, "object_id")
    valid = reconcile.segment_is_valid(F.col("seg_class"), boxes.box("x1", "y1", "x2", "y2"), F.col("seg_area"))
    ok = reconcile.is_training_sample(valid, F.col("covers"), F.col("vlm_label"), F.col("seg_class"), F.array().cast("array<string>"), ["person", "car", "dog", "cat"])
    return j.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(ok, F.lit(False))).alias("training"))


@query(f"""WITH {DECIDED} SELECT object_id, d.feed_label AS source_class, k.seg_class AS sam_class, k.seg_area::BIGINT AS mask_area, covers, vlm_label AS class_label, vlm_error AS error, status, reason FROM d JOIN k USING (object_id)""")
def x07_provenance(t):
    # one parse of a text gives all fields
    kinds = "source struct<class_name:string>, sam struct<class_name:string,mask_area:string>, vlm struct<class_label:string,error:string,bbox_covers_object:boolean>, decision struct<status:string,reason:string>"
    fields = {"source_class": "source.class_name", "sam_class": "sam.class_name", "class_label": "vlm.class_label", "error": "vlm.error", "status": "decision.status", "reason": "decision.reason"}
    parsed = reconcile.provenance(_decisions(t)).select("object_id", F.from_json("provenance_json", kinds).alias("p"))
    texts = [F.col(f"p.{path}").alias(name) for name, path in fields.items()]
    return parsed.select("object_id", *texts, F.col("p.sam.mask_area").cast("long").alias("mask_area"), F.col("p.vlm.bbox_covers_object").alias("covers"))


@query("""SELECT object_id, coalesce(seg_class, '') <> '' AS has_sam, covers IS NOT NULL AS has_vlm, nullif(vlm_error, 'sam') AS vlm_error FROM {segments} JOIN {verdicts} USING (object_id)""")
def x14_decision_details(t):
    return reconcile.decision_details(_decisions(t)).select("object_id", "has_sam", "has_vlm", "vlm_error")


@query("""SELECT id FROM {annotations} WHERE verified = 1""")
def b01_best_annotations(t):
    return dedup.best_annotations(t.annotations, True).select("id")


@query(f"""SELECT id AS sample_id, {SPLIT} AS split, n AS lines, camera, ts AS timestamp FROM (SELECT s.id, camera, ts, n, {POINT.format("s.id")} AS p FROM {{samples}} s
 JOIN (SELECT sample_id, count(*) AS n FROM {{annotations}} WHERE label = 'car' GROUP BY sample_id) a ON a.sample_id = s.id)
UNION ALL SELECT concat(id, 'n'), 'train', 0, NULL, NULL FROM {{samples}} WHERE status = 'imported'""")
def b03_build_from_audit(t):
    lines = t.annotations.where("label = 'car'").select("sample_id", F.col("id").alias("line_no"), F.lit("2 0.5 0.5 0.1 0.1").alias("line"))
    records = t.samples.select(F.col("id").alias("sample_id"), "camera", F.col("ts").alias("timestamp"))
    own = records.select("sample_id")
    out = datasets.build_from_audit(own, t.samples.where("status = 'imported'").select(F.concat("id", F.lit("n")).alias("sample_id")), lines, records)
    return out.select("sample_id", "split", F.regexp_count("body", F.lit("2 0.5 0.5 0.1 0.1(\n|$)")).cast("long").alias("lines"), "camera", "timestamp")


@query(f"""SELECT sample_id, n AS boxes FROM (SELECT sample_id, count(*) AS n, bool_and(label IN ('person', 'car') AND y2 IS NOT NULL) AS ok, {POINT.format("sample_id")} AS p FROM {{annotations}} GROUP BY sample_id)
WHERE ok AND p < 0.8 AND sample_id NOT LIKE '%5'""")
def b04_build_golden(t):
    own = t.samples.select(F.col("id").alias("sample_id"))
    lines = t.annotations.select("sample_id", F.col("id").alias("line_no"), "label", F.col("y2").isNotNull().alias("valid"), F.lit("0.5 0.5 0.1 0.1").alias("rest"))
    out = datasets.build_golden(own, lines, own.where("sample_id like '%5'"), labels.class_table(t.spark, ["person", "car"]), split="train")
    return out.select("sample_id", F.col("boxes").cast("long").alias("boxes"))


@query("""SELECT CASE label WHEN 'dog' THEN 'class-16' ELSE label END AS label, count(*) AS boxes, (SELECT count(*) FROM {samples}) AS images
FROM {annotations} WHERE sample_id NOT IN (SELECT sample_id FROM {annotations} WHERE y2 IS NULL) GROUP BY ALL""")
def a06_golden_summary(t):
    lines = t.annotations.select(F.col("sample_id").alias("file"), labels.class_index(F.col("label")).alias("class_id"), F.col("y2").isNotNull().alias("valid"))
    names = labels.class_table(t.spark, ["person", "car"], "coco80")
    return datasets.golden_summary(lines, names, t.samples).select("label", "boxes", "images")


@query("""SELECT 'annotation' AS what, id, sample_id, label, x2, verified FROM {annotations} WHERE NOT (source = 'vlm' AND sample_id LIKE '%3')
UNION ALL SELECT 'annotation', concat(id, '-vlm-1970-01-01T00:00:00-0'), id, 'car', 0.5, 1 FROM {samples} WHERE id LIKE '%3'
UNION ALL SELECT 'sample', id, id, NULL, NULL, CASE WHEN id LIKE '%3' THEN 1 ELSE verified END FROM {samples}""")
def m02_store_verified(t):
    item = F.struct(F.lit("car").alias("label"), F.lit(0.9).alias("confidence"), *[F.lit(v).alias(k) for k, v in (("x1", 0.1), ("y1", 0.1), ("x2", 0.5), ("y2", 0.5))])
    results = t.samples.where("id like '%3'").select(F.col("id").alias("sample_id"), F.array(item).alias("objects"))
    s, a = ledger.store_verified(t.samples, t.annotations, results, ["car"], mode="replace")
    own = s.select(F.lit("sample"), "id", "id", F.lit(None).cast("string"), F.lit(None).cast("double"), "verified")
    return a.select(F.lit("annotation").alias("what"), "id", "sample_id", "label", "x2", "verified").union(own)


@query("""SELECT id, CASE WHEN id LIKE '%4' THEN 'bad' ELSE quality END AS quality FROM {samples}""")
def m03_drop_rejected(t):
    results = t.samples.select(F.col("id").alias("sample_id"), F.when(F.col("id").endswith("4"), "rejected").otherwise("transport").alias("status"))
    return ledger.drop_rejected(t.samples, results).select("id", "quality")


@query("""SELECT name AS model_name, CASE WHEN (latency_ms IS NULL OR latency_ms <= 20) AND (cpu_percent IS NULL OR cpu_percent <= 80) THEN 'PASS' ELSE 'FAIL' END AS verdict FROM {candidates}""")
def m06_deployment_rows(t):
    return ledger.deployment_rows(evaluate.gate(t.candidates, "no such model"), "v1", "2024-01-01").select("model_name", "verdict")


@query("""SELECT id AS event_id, 'in progress' AS error FROM {event_feed} WHERE end_time IS NULL""")
def m07_failure_rows(t):
    failed = feeds.refused_events(t.event_feed.withColumn("box", boxes.from_xywh(F.col("box")))).where("outcome = 'failed'")
    return ledger.failure_rows(failed.select(F.col("id").alias("event_id"), "camera", F.lit("in progress").alias("error")), "now").select("event_id", "error")


@query("""SELECT candidate, avg(latency_ms) AS latency_ms, CASE WHEN avg(latency_ms) <> 0 THEN 1000 / avg(latency_ms) END AS fps FROM (SELECT l_suppkey % 4 AS candidate, l_linenumber::DOUBLE AS latency_ms FROM {lineitem} WHERE l_linenumber > 1) GROUP BY candidate""")
def e07_latency_summary(t):
    timings = t.lineitem.select((F.col("l_suppkey") % 4).alias("candidate"), F.col("l_linenumber").cast("double").alias("latency_ms"), (F.col("l_linenumber") == 1).alias("warmup"))
    return evaluate.latency_summary(timings)


@query("""SELECT s.id AS image_id, count(*) AS n FROM {samples} s JOIN {annotations} a ON a.sample_id = s.id WHERE label IN ('person', 'car') GROUP BY s.id""")
def e06_golden_examples(t):
    own = t.annotations.select(F.col("sample_id").alias("image_id"), F.when(F.col("label") == "person", 0).when(F.col("label") == "car", 1).alias("class_id"), "x1", "y1", "x2", "y2")
    out = evaluate.golden_examples(t.samples.select(F.col("id").alias("image_id")), own, labels.class_table(t.spark, ["person", "car"]))
    return out.where("boxes is not null").select("image_id", F.size("boxes").cast("long").alias("n"))


# --- box functions as table jobs

MASKS = "SELECT *, 10 + k % 7 AS ma, 40 + k % 7 AS mb FROM {segments}"


def _masked(t: Tables) -> DataFrame:
    """Segments with their feed box and segment box in a 100 x 100 image, and a mask of runs."""
    runs = _mask(lambda shift: 10 + shift, lambda shift: 40 + shift)
    feed = boxes.box(F.col("x1") * 100, F.col("y1") * 100, F.col("x2") * 100, F.col("y2") * 100)
    seg = boxes.box(F.lit(10) + F.col("k") % 7, F.lit(0), F.lit(40) + F.col("k") % 7, F.lit(100))
    return t.segments.select("object_id", "k", feed.alias("feed"), seg.alias("seg"), runs.alias("runs"))


OVERLAP = "greatest(0, least(x2 * 100, mb) - greatest(x1 * 100, ma)) * greatest(0, least(y2 * 100, 100) - greatest(y1 * 100, 0))"


@query(f"""SELECT object_id, round(1e6 * {OVERLAP} / ((x2 - x1) * (y2 - y1) * 10000))::BIGINT AS share FROM ({MASKS})""")
def g04_containment(t):
    return _masked(t).select("object_id", F.round(1e6 * boxes.containment(F.col("feed"), F.col("seg"))).cast("long").alias("share"))


@query(f"""SELECT object_id, ma - x1 * 100 AS dx1, 0 - y1 * 100 AS dy1, mb - x2 * 100 AS dx2, 100 - y2 * 100 AS dy2 FROM ({MASKS})""")
def g05_edge_deltas(t):
    d = boxes.edge_deltas(F.col("feed"), F.col("seg"))
    return _masked(t).select("object_id", *[d[k].alias(f"d{k}") for k in ("x1", "y1", "x2", "y2")])


@query("""SELECT id, CASE WHEN w > 0 THEN x1 * w END AS px1, CASE WHEN w > 0 THEN y2 * 50 END AS py2, CASE WHEN w > 0 THEN x1 / w END AS nx1, CASE WHEN w > 0 THEN y2 / 50 END AS ny2, (x1 + x2) / 2 AS cx, y2 - y1 AS h
FROM (SELECT *, CASE WHEN verified = 1 THEN 100 ELSE 0 END AS w FROM {annotations})""")
def g09_pixel_boxes(t):
    b, w = boxes.box("x1", "y1", "x2", "y2"), F.when(F.col("verified") == 1, 100).otherwise(0)
    px, unit, centre = boxes.scaled(b, w, 50), boxes.normalized(b, w, 50), boxes.to_cxcywh(b)
    return t.annotations.select("id", px["x1"].alias("px1"), px["y2"].alias("py2"), unit["x1"].alias("nx1"), unit["y2"].alias("ny2"), F.get(centre, 0).alias("cx"), F.get(centre, 3).alias("h"))


@query("""SELECT object_id, x1 - k AS x1, y1 - 2 AS y1, x2 - k AS x2, y2 - 2 AS y2 FROM {segments}""")
def g10_crop_boxes(t):
    return t.segments.select("object_id", boxes.frame_to_crop(boxes.box("x1", "y1", "x2", "y2"), F.col("k"), 2).alias("b")).select("object_id", "b.*")


@query("""WITH s AS (SELECT id, x1 * 100 AS x1, y1 * 100 AS y1, x2 * 100 AS x2, y2 * 100 AS y2, CASE verified WHEN 1 THEN 90 ELSE CASE source WHEN 'vlm' THEN 0 ELSE 100 END END AS w FROM {annotations}),
r AS (SELECT *, CASE WHEN w <= 0 THEN 'bad_size' WHEN NOT coalesce(x1 BETWEEN 0 AND w AND x2 BETWEEN 0 AND w AND y1 BETWEEN 0 AND 100 AND y2 BETWEEN 0 AND 100, false) THEN 'out_of_range' WHEN x2 <= x1 OR y2 <= y1 THEN 'degenerate_box' END AS reason FROM s)
SELECT id, reason, CASE WHEN reason IS NULL THEN x1 / w END AS x1, CASE WHEN reason IS NULL THEN y2 / 100 END AS y2 FROM r""")
def g15_checked_boxes(t):
    w = F.when(F.col("verified") == 1, 90).when(F.col("source") == "vlm", 0).otherwise(100)
    px = boxes.box(F.col("x1") * 100, F.col("y1") * 100, F.col("x2") * 100, F.col("y2") * 100)
    b, reason = boxes.checked_normalized(px, w, 100)
    return t.annotations.select("id", reason.alias("reason"), b["x1"].alias("x1"), b["y2"].alias("y2"))


@query(f"""SELECT object_id, round(1e6 * 3000 / ((x2 - x1) * (y2 - y1) * 10000))::BIGINT AS ratio FROM ({MASKS})""")
def g19_mask_box_ratio(t):
    return _masked(t).select("object_id", F.round(1e6 * boxes.mask_box_ratio(F.col("runs"), F.col("feed"))).cast("long").alias("ratio"))


INSIDE = "greatest(0, least(mb, ceil(x2 * 100)) - greatest(ma, ceil(x1 * 100))) * greatest(0, least(100, ceil(y2 * 100)) - greatest(0, ceil(y1 * 100))) / 3000"


@query(f"""SELECT object_id, {INSIDE} AS share FROM ({MASKS})""")
def g20_mask_containment(t):
    return _masked(t).select("object_id", boxes.mask_containment(F.col("runs"), F.col("feed")).alias("share"))


# of the box in pixels, as the query has it: the order of the products decides how halves round
FEED_AREA = "((x2 * 100 - x1 * 100) * (y2 * 100 - y1 * 100))"


@query(f"""SELECT object_id, 3000 AS mask_area, round(1e3 * {FEED_AREA})::BIGINT AS feed_area, round(1e6 * ({OVERLAP} / ({FEED_AREA} + 3000 - {OVERLAP})))::BIGINT AS iou,
 round(1e6 * ({OVERLAP} / 3000))::BIGINT AS segment_in_feed, round(1e6 * {INSIDE})::BIGINT AS mask_in_feed, 1000000 AS mask_in_box FROM ({MASKS})""")
def g21_object_geometry(t):
    g = _masked(t).select("object_id", boxes.object_geometry(F.col("feed"), F.col("seg"), F.col("runs")).alias("g"))
    return g.select(
        "object_id", "g.mask_area", F.round(1e3 * F.col("g.feed_area")).cast("long").alias("feed_area"), F.round(1e6 * F.col("g.bbox_iou")).cast("long").alias("iou"),
        F.round(1e6 * F.col("g.segment_feed_containment")).cast("long").alias("segment_in_feed"), F.round(1e6 * F.col("g.mask_feed_containment")).cast("long").alias("mask_in_feed"), F.round(1e6 * F.col("g.mask_bbox_ratio")).cast("long").alias("mask_in_box"),
    )


# --- response checks


@query("""SELECT object_id, CASE WHEN k % 4 = 0 AND covers IS NOT NULL THEN covers END AS covers, CASE WHEN k % 4 = 0 AND covers IS NOT NULL THEN trim(vlm_label) END AS vlm_label,
 CASE WHEN k % 4 = 3 THEN 'transport' WHEN k % 4 = 0 AND covers IS NOT NULL THEN NULL ELSE 'malformed' END AS vlm_error FROM {verdicts} JOIN {segments} USING (object_id)""")
def l09_parse_verdicts(t):
    d = t.verdicts.join(t.segments.select("object_id", "k"), "object_id")
    # whole, with the flag as text, cut short, and missing
    good = F.concat(F.lit('Fine: {"bbox_covers_object": '), F.coalesce(F.col("covers").cast("string"), F.lit("null")), F.lit(', "class_label": "'), F.coalesce("vlm_label", F.lit("")), F.lit(' "}'))
    said = F.when(F.col("k") % 4 == 0, good).when(F.col("k") % 4 == 1, F.regexp_replace(good, "(true|false|null)", '"$1"')).when(F.col("k") % 4 == 2, F.substring(good, 1, 30))
    return scoring.parse_verdicts(d.select("object_id", said.alias("content"))).select("object_id", "covers", "vlm_label", "vlm_error")


@query("""SELECT object_id, CASE WHEN trim(coalesce(seg_class, '')) = '' THEN 'no_class' WHEN k % 11 = 0 THEN 'bad_bbox' WHEN seg_area = 0 THEN 'no_mask' WHEN k % 3 = 0 THEN 'mask_size' WHEN k % 5 = 0 THEN 'bad_confidence' END AS reason FROM {segments}""")
def l10_check_segments(t):
    four = F.array("x1", "y1", "x2", "y2")
    d = t.segments.select(
        "object_id", F.col("seg_class").alias("class_name"), F.when(F.col("k") % 11 == 0, F.slice(four, 1, 3)).otherwise(four).alias("bbox"), F.when(F.col("seg_area") > 0, F.array(F.struct(F.lit(0).alias("y"), F.lit(0).alias("x0"), F.lit(9).alias("x1")))).alias("mask"),
        F.lit(64).alias("mask_w"), F.lit(64).alias("mask_h"), F.when(F.col("k") % 3 == 0, 63).otherwise(64).alias("crop_w"), F.lit(64).alias("crop_h"), F.when(F.col("k") % 5 == 0, float("nan")).otherwise(0.5).alias("confidence"),
    )
    return scoring.check_segments(d).select("object_id", "reason")


@query("""SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, event_type <> 'click' AND event_type <> 'view' AS parsed FROM {events}""")
def l11_tolerant_json(t):
    text = F.when(F.col("event_type") == "click", F.concat("props", F.lit("{"))).when(F.col("event_type") == "view", F.lit("  ")).otherwise(F.col("props"))
    d = t.events.select("event_id", labels.tolerant_json(text).alias("v"), labels.tolerant_json(F.col("props")).alias("p"))
    return d.select("event_id", F.try_variant_get("p", "$.k", "long").alias("k"), F.col("v").isNotNull().alias("parsed"))


@query(f"""SELECT id, CASE WHEN content IS NULL OR content NOT LIKE '%{{{{%' THEN '' WHEN content LIKE '%"name"%' THEN 'keys_or_types' WHEN content LIKE '%"confidence": 7%' THEN
 CASE WHEN {X2} <= {X1} THEN 'confidence,bbox' ELSE 'confidence' END WHEN {X2} <= {X1} THEN 'bbox' ELSE '' END AS messages,
 CASE WHEN content IS NULL THEN 'transport' WHEN content NOT LIKE '%{{{{%' THEN 'no_objects' WHEN content LIKE '%"name"%' OR content LIKE '%"confidence": 7%' OR {X2} <= {X1} THEN 'bad_object' END AS reason FROM {{responses}}""")
def l08_rejection_messages(t):
    return scoring.parse_detections(t.responses).select("id", F.array_join("messages.problem", ",").alias("messages"), "reason")


@query("""WITH b AS (SELECT id, least(greatest(x1 * 1.5 - 0.25, 0), 1) AS x1, least(greatest(y1 * 1.5 - 0.25, 0), 1) AS y1,
 least(greatest(CASE WHEN id LIKE '%2' THEN x1 * 1.5 - 0.24995 ELSE x2 * 1.5 - 0.25 END, 0), 1) AS x2, least(greatest(y2 * 1.5 - 0.25, 0), 1) AS y2 FROM {annotations} WHERE y2 IS NOT NULL)
SELECT id, CASE WHEN ok THEN x1 END AS x1, CASE WHEN ok THEN y1 END AS y1, CASE WHEN ok THEN CASE WHEN x2 - x1 < 1e-4 THEN x1 + 1e-4 ELSE x2 END END AS x2, CASE WHEN ok THEN y2 END AS y2 FROM (SELECT *, x2 > x1 AND y2 > y1 AS ok FROM b)""")
def g17_clamped_boxes(t):
    """Boxes that leave the unit square, and slivers."""
    own = t.annotations.where("y2 is not null")
    sliver = F.when(F.col("id").like("%2"), F.col("x1") * 1.5 - 0.24995).otherwise(F.col("x2") * 1.5 - 0.25)
    b = boxes.clamped_model_box(boxes.box(F.col("x1") * 1.5 - 0.25, F.col("y1") * 1.5 - 0.25, sliver, F.col("y2") * 1.5 - 0.25))
    return own.select("id", b.alias("b")).select("id", *[F.col("b")[k].alias(k) for k in ("x1", "y1", "x2", "y2")])


# --- file formats over derived texts


@query("""SELECT concat('doc/', doc_id) AS path, octet_length(encode(text)) AS length, sha256(text) AS content_hash FROM {documents} WHERE text IS NOT NULL""")
def s10_image_hashes(t):
    from ..sources import files

    content = F.to_binary("text", F.lit("utf-8"))
    return files.image_hashes(t.documents.where("text is not null").select(F.concat(F.lit("doc/"), "doc_id").alias("path"), F.length(content).cast("long").alias("length"), content.alias("content")))


@query("""SELECT concat('hash-', sha256(concat('pixels ', image_path))) AS content_hash, count(*) AS n FROM {samples} GROUP BY content_hash""")
def h06_content_hash(t):
    return t.samples.groupBy(F.concat(F.lit("hash-"), hashes.content_hash(F.to_binary(F.concat(F.lit("pixels "), "image_path"), F.lit("utf-8")))).alias("content_hash")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH o AS (SELECT o_orderkey AS file, l_linenumber AS ln, row_number() OVER (PARTITION BY l_orderkey ORDER BY n) - 1 AS pos, concat('s', l_orderkey, '-', n) AS id, l_returnflag AS cls, l_partkey % 9 = 0 AS no_class, l_suppkey % 13 = 0 AS no_image, (l_partkey % 50) / 100.0::DOUBLE AS x
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS n FROM {lineitem}) JOIN {orders} ON o_orderkey = l_orderkey)
SELECT id AS object_id, pos::INT AS manifest_index, CASE WHEN no_class THEN 'missing_class' WHEN no_image THEN 'missing_image' ELSE 'ok' END AS reason, CASE WHEN no_class OR no_image THEN NULL ELSE round(x * 200 * 1000)::BIGINT END AS x1 FROM o""")
def s08_audit_manifest(t):
    from ..sources import files

    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    x = (F.col("l_partkey") % 50) / 100
    lines = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey").withColumn("n", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)))
    item = F.struct(
        "n", F.concat(F.lit("s"), "l_orderkey", F.lit("-"), "n").alias("id"), F.when(F.col("l_suppkey") % 13 != 0, F.lit("i.jpg")).alias("image"), F.when(F.col("l_partkey") % 9 != 0, F.col("l_returnflag")).alias("class_name"),
        F.array(x, F.lit(0.1), F.lit(0.4), F.lit(0.5)).alias("bbox"),
    )
    texts = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(item)).alias("objects")).select(
        F.to_json(F.struct(F.lit("/img").alias("image_root"), F.lit("xywh").alias("bbox_format"), F.lit(True).alias("normalized"), F.array(F.lit(200.0), F.lit(100.0)).alias("frame_size"), F.map_from_arrays(F.array(F.lit("A"), F.lit("N"), F.lit("R")), F.array(F.lit(0), F.lit(1), F.lit(2))).alias("class_map"), "objects")).alias("j")
    )
    good, bad = files.parse_audit_manifest(texts.select(F.from_json("j", schemas.AUDIT_MANIFEST).alias("m")).select("m.*"), 200, 100)
    return good.select("object_id", "manifest_index", F.lit("ok").alias("reason"), F.round(F.col("box.x1") * 1000).cast("long").alias("x1")).union(bad.select("object_id", "manifest_index", "reason", F.lit(None).cast("long")))


@query("""SELECT row_number() OVER (ORDER BY p_brand) - 1 AS class_id, p_brand AS label FROM (SELECT DISTINCT p_brand FROM {part})""")
def s14_class_names(t):
    from ..sources import files

    lines = t.part.select("p_brand").distinct().agg(F.sort_array(F.collect_set("p_brand")).alias("b"))
    text = F.array_join(F.transform("b", lambda x, i: F.concat(F.lit("  "), i.cast("string"), F.lit(": '"), x, F.lit("'"))), "\n")
    return files.parse_class_names(lines.select(F.concat(F.lit("path: x\nnames:\n"), text).alias("value")), True)


@query(f"""WITH {DECIDED} SELECT object_id, CASE WHEN length(object_id) % 2 = 0 THEN feed_label ELSE NULL END AS feed_label, status, reason, CASE WHEN length(object_id) % 2 = 0 THEN 'z' || feed_label END AS zone FROM d WHERE object_id NOT LIKE '%-1'""")
def s15_decision_files(t):
    from ..sources import files

    own = F.length("object_id") % 2 == 0
    source = F.when(own, F.struct(F.col("feed_label").alias("class_name"), F.concat(F.lit("z"), "feed_label").alias("zone")))
    whole = F.to_json(F.struct(F.struct("status", "reason").alias("decision"), F.struct(source.alias("source")).alias("provenance")))
    texts = _decisions(t).select(F.concat(F.lit("/run/"), "object_id", F.lit("/decision.json")).alias("file"), F.when(F.col("object_id").like("%-1"), "{broken").otherwise(whole).alias("value"))
    return files.parse_decisions(texts).select("object_id", "feed_label", "status", "reason", F.element_at("extra", "zone").alias("zone"))


@query("""WITH k AS (SELECT concat('s', o_orderkey) AS key, 0 AS p, o_orderkey AS line, o_custkey AS n FROM {orders} UNION ALL SELECT concat('s', o_custkey), 1, o_orderkey, o_custkey FROM {orders})
SELECT key, n FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY p, line) AS r FROM k) WHERE r = 1""")
def s16_provenance_keys(t):
    from ..sources import files

    line = F.to_json(F.struct(F.concat(F.lit("s"), "o_orderkey").alias("sample_id"), F.struct(F.concat(F.lit("s"), "o_custkey").alias("sample_id")).alias("source"), F.col("o_custkey").alias("n")))
    out = files.parse_provenance(t.orders.select(F.col("o_orderkey").alias("line"), line.alias("value")))
    return out.select("key", F.get_json_object("record", "$.n").cast("long").alias("n"))


@query("""SELECT name, version, map50, recall, fp_rate, latency_ms, cpu_percent FROM {candidates}""")
def s18_benchmark_file(t):
    from ..sources import files

    return files.parse_benchmark_lines(files.benchmark_lines(t.candidates).select("value")).select("name", "version", "map50", "recall", "fp_rate", "latency_ms", "cpu_percent")


@query(f"""SELECT split, id AS sample_id, row_number() OVER (PARTITION BY split ORDER BY id) - 1 AS place FROM (SELECT id, {SPLIT} AS split FROM (SELECT id, {POINT.format("id")} AS p FROM {{samples}}))""")
def s19_dataset_lists(t):
    """Ids of every split in order."""
    from ..sources import files

    lists = files.dataset_lists(datasets.split_lists(t.samples.select("id")).withColumnRenamed("id", "sample_id"))
    return lists.select("split", "sample_id", "place")


@query(f"""WITH p AS (SELECT *, {SPLIT} AS split FROM (SELECT *, {POINT.format("id")} AS p FROM {{samples}}))
SELECT split, id AS sample_id, camera, verified, true AS listed, (SELECT count(*) FROM {{samples}}) AS total FROM p UNION ALL SELECT 'classes', 'person', '0', NULL, NULL, NULL UNION ALL SELECT 'classes', 'car', '1', NULL, NULL, NULL UNION ALL SELECT 'classes', 'dog', '2', NULL, NULL, NULL""")
def s19_dataset_version(t):
    """Writes a dataset version (manifest, lists, classes, summary) and reads all of it back; a second write is refused."""
    from pyspark.errors import AnalysisException

    from ..sources import files

    path, _ = _folders(t, "dataset")
    own = t.samples.select(hashes.assign_split(F.col("id"), datasets.RATIOS, "1").alias("split"), F.col("id").alias("sample_id"), "camera", "verified")
    summary = t.samples.agg(F.count(F.lit(1)).alias("total"))
    files.write_dataset(own, summary, path, classes=_class_table(t))
    try:
        files.write_dataset(own, summary, path)
        raise AssertionError("a version was written twice")
    except AnalysisException:
        pass
    read = lambda kind, schema: t.spark.read.schema(schema).json(f"{path}/{kind}")
    listed = t.spark.read.schema("value string, split string").text(f"{path}/lists").select("split", F.col("value").alias("sample_id"), F.lit(True).alias("listed"))
    rows = read("manifest", "sample_id string, camera string, verified int, split string").join(listed.hint("merge"), ["split", "sample_id"], "full")
    rows = rows.select("split", "sample_id", "camera", "verified", "listed").crossJoin(F.broadcast(read("build", "total long")))  # one row
    names = read("classes", "class_id int, label string").select(F.lit("classes").alias("split"), F.col("label").alias("sample_id"), F.col("class_id").cast("string").alias("camera"), *[F.lit(None).cast(k).alias(c) for c, k in (("verified", "int"), ("listed", "boolean"), ("total", "long"))])
    return rows.union(names)


# --- summaries, indexes and ledgers


@query("""WITH v AS (SELECT DISTINCT o_custkey % 100 AS k, concat('v', lpad((o_custkey % 100)::VARCHAR, 3, '0')) AS version FROM {orders})
SELECT version, CASE WHEN k % 3 = 0 THEN NULL ELSE k END AS written, CASE WHEN k % 3 = 0 THEN 'missing or unreadable build summary' END AS error FROM v""")
def a08_dataset_listing(t):
    v = t.orders.select((F.col("o_custkey") % 100).alias("k")).distinct().select("k", F.concat(F.lit("v"), F.lpad(F.col("k").cast("string"), 3, "0")).alias("version"))
    summaries = v.where("k % 3 <> 0").select("version", F.lit("2024").alias("built_at"), F.col("k").alias("written"))
    return pool.dataset_listing(v.select("version"), summaries).select("version", "written", "error")


@query("""SELECT (SELECT count(*) FROM {reviews}) AS reviews, count(*) AS events, count(*) FILTER (o = 'new') AS "new", count(*) FILTER (o = 'duplicate') AS duplicate, count(*) FILTER (o = 'merged') AS merged, count(*) FILTER (o = 'failed') AS failed,
 count(*) FILTER (o = 'skipped') AS skipped, (sum(CASE WHEN o IN ('new', 'merged') THEN 1 ELSE 0 END))::BIGINT AS annotations
FROM (SELECT CASE WHEN end_time IS NULL THEN 'failed' ELSE CASE o_custkey % 4 WHEN 0 THEN 'new' WHEN 1 THEN 'duplicate' WHEN 2 THEN 'merged' ELSE 'skipped' END END AS o FROM {event_feed} JOIN {orders} ON id = concat('e', o_orderkey))""")
def a11_collect_summary(t):
    outcome = F.when(F.col("end_time").isNull(), "failed").otherwise(F.element_at(F.array(*[F.lit(n) for n in ("new", "duplicate", "merged", "skipped")]), (F.col("o_custkey") % 4 + 1).cast("int")))
    d = t.event_feed.join(t.orders.select(F.concat(F.lit("e"), "o_orderkey").alias("id"), "o_custkey"), "id").select(outcome.alias("outcome"))
    return pool.collect_summary(t.reviews, d.withColumn("annotations", F.col("outcome").isin("new", "merged").cast("long")))


@query("""SELECT (SELECT count(*) FROM {orders}) AS images, (SELECT count(*) FROM {lineitem}) AS objects, (SELECT count(*) FROM {lineitem} WHERE l_returnflag = 'R') AS skipped_unmapped,
 (SELECT count(*) FROM {orders} WHERE o_orderkey % 5 = 0) AS skipped_missing, (SELECT count(DISTINCT l_orderkey) FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE l_returnflag IN ('A', 'N') AND o_orderkey % 5 <> 0) AS written""")
def a16_import_summary(t):
    from ..sources import files

    present = t.orders.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").cast("string").alias("file_name"))
    return files.import_coco(_coco(t), ["person", "car"], {"human": "person"}, present)[2].select("images", "objects", "skipped_unmapped", "skipped_missing", "written")


@query("""SELECT name AS id, map50, row_number() OVER (ORDER BY version DESC, name) AS place, CASE WHEN length(name) % 2 = 1 THEN recall END AS recall FROM {candidates}""")
def k03_deployments(t):
    d = t.candidates.select(F.col("name").alias("id"), F.col("version").alias("created_at"), F.to_json(F.struct("map50")).alias("metrics_json"), F.when(F.length("name") % 2 == 1, F.to_json(F.struct("recall"))).otherwise("{").alias("reasons_json"))
    out = pool.deployments_newest(d)
    place = F.row_number().over(Window.orderBy(F.desc("created_at"), "id"))  # a ledger of models
    return out.select("id", F.try_variant_get("metrics", "$.map50", "double").alias("map50"), place.alias("place"), F.try_variant_get("reasons", "$.recall", "double").alias("recall"))


@query(f"""WITH {DECIDED}, q AS (SELECT object_id, feed_label, {OVERLAP} AS inter, (x2 - x1) * (y2 - y1) * 10000 AS area, {INSIDE} AS inside FROM ({MASKS})),
g2 AS (SELECT object_id, concat_ws(',', CASE WHEN inter / (area + 3000 - inter) < 0.05 THEN 'geometry:bbox_iou' END, CASE WHEN inside < 0.1 THEN 'geometry:mask_feed_containment' END) AS broken FROM q)
SELECT d.object_id, CASE WHEN d.status = 'KEEP' AND broken <> '' THEN 'DROP' ELSE d.status END AS status, CASE WHEN d.status = 'KEEP' AND broken <> '' THEN 'sam_geometry' ELSE reason END AS reason FROM d JOIN g2 USING (object_id)""")
def x03_geometry_gates(t):
    shaped = _masked(t).select("object_id", boxes.object_geometry(F.col("feed"), F.col("seg"), F.col("runs")).alias("g"))
    segments = t.segments.withColumn("seg_box", boxes.box("x1", "y1", "x2", "y2")).join(shaped.hint("merge"), "object_id")
    gates = reconcile.Gates(min_bbox_iou=0.05, min_containment=0.1)
    out = reconcile.decide(t.segments.select("object_id", "feed_label"), segments, t.verdicts, ["person", "car", "dog", "cat"], gates, "g")
    return out.select("object_id", "status", "reason")


@query(f"""WITH {DECIDED} SELECT (SELECT string_agg(object_id, ',' ORDER BY object_id) FROM (SELECT object_id FROM d WHERE status = 'KEEP' AND feed_label = 'car' ORDER BY object_id LIMIT 50 OFFSET 10)) AS page,
 (SELECT count(*) FROM d WHERE status = 'KEEP' AND feed_label = 'car') AS total, (SELECT string_agg(DISTINCT feed_label, ',' ORDER BY feed_label) FROM d) AS labels, (SELECT max(object_id) FROM d) AS newest,
 (SELECT count(*) FROM d) AS processed, (SELECT count(DISTINCT feed_label) + 1 FROM d) AS n_statistics""")
def x13_audit_index(t):
    out = reconcile.audit_index(_decisions(t).withColumn("updated_at", F.col("object_id")), "KEEP", "car", 50, 10)
    overall = F.get(F.filter("statistics", lambda s: s["overall"] == 1), F.lit(0))["processed"]
    return out.select(F.array_join("page.object_id", ",").alias("page"), "total", F.array_join("labels", ",").alias("labels"), F.col("updated_at").alias("newest"), overall.alias("processed"), F.size("statistics").cast("long").alias("n_statistics"))


@query("""SELECT sample_id, reason, CASE WHEN reason IS NULL THEN CASE WHEN h < 5 THEN 'night' WHEN h < 9 THEN 'dawn' WHEN h < 17 THEN 'day' WHEN h < 21 THEN 'dusk' ELSE 'night' END END AS time_bucket FROM
 (SELECT id AS sample_id, (ts // 3600) % 24 AS h, CASE WHEN length(camera) = 5 THEN 'image_type' WHEN quality = 'bad' THEN 'duplicate_id' END AS reason FROM {samples})""")
def b05_append_golden(t):
    image = F.concat(F.col("id"), F.when(F.length("camera") == 5, F.lit(".txt")).otherwise(F.lit(".JPG")))
    images = t.samples.select(F.col("id").alias("sample_id"), image.alias("image"), F.col("ts").alias("timestamp"), F.lit(None).cast("string").alias("time_bucket"))
    known = t.samples.where("quality = 'bad'").select(F.col("id").alias("sample_id"))
    good, bad = datasets.append_golden(known, images)
    return good.select("sample_id", F.lit(None).cast("string").alias("reason"), "time_bucket").union(bad.select("sample_id", "reason", F.lit(None).cast("string")))


@query("""SELECT id, CASE WHEN y2 IS NULL THEN 'rejected' WHEN x2 <= x1 THEN 'transport' ELSE 'ok' END AS status, CASE WHEN y2 IS NOT NULL AND x2 > x1 THEN (x2 - x1) * (y2 - y1) END AS area FROM {annotations}""")
def r04_score_table(t):
    def make_model():
        def area(row):
            if row["y2"] is None or row["y2"] != row["y2"]:
                raise ValueError("no bottom edge")
            if row["x2"] <= row["x1"]:
                raise RuntimeError("empty box")
            return {"area": (row["x2"] - row["x1"]) * (row["y2"] - row["y1"])}

        return area

    return scoring.score_table(t.annotations, make_model, ["id", "x1", "y1", "x2", "y2"], "area double").select("id", "status", "area")


@query("""SELECT 'a' AS part, object_id, b.n, b.hit FROM (SELECT object_id FROM {segments}) s, (SELECT unnest([0, 1]) AS n, true AS hit) b""")
def x11_background_boxes(t):
    """Every box is a free square of the fixed size: the draws are seeded hashes, which SQL here cannot repeat."""
    own = t.segments.select("object_id", "x1", "y1", "x2", "y2")
    found = reconcile.background_boxes(own, 2, size=0.05).select("object_id", "n", "box", boxes.box("x1", "y1", "x2", "y2").alias("own"))
    b = F.col("box")
    hit = (boxes.iou(b, F.col("own")) <= 0.2) & (F.abs(b["x2"] - b["x1"] - 0.05) < 1e-9) & (F.abs(b["y2"] - b["y1"] - 0.05) < 1e-9) & (b["x1"] >= 0) & (b["y2"] <= 1)
    return found.select(F.lit("a").alias("part"), "object_id", "n", hit.alias("hit"))


# --- streams over the tables' files, run to their end


def _stream(t: Tables, name: str) -> DataFrame:
    return t.spark.readStream.schema(getattr(t, name).schema).parquet(f"{t.sf_dir}/{name}.parquet*")


def _folders(t: Tables, name: str) -> tuple[str, str]:
    base = f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"
    return f"{base}/table", f"{base}/checkpoint"


@query("""SELECT DISTINCT concat('e', o_custkey) AS id FROM {orders}""")
def r01_collect_events(t):
    """New events of a feed with repeats, collected twice. The second stream starts anew and sees every event again: all of them
    are found in the table."""
    target, _ = _folders(t, "events")
    for _ in range(2):
        feed = _stream(t, "orders").select(F.concat(F.lit("e"), "o_custkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("ts"))
        incremental.collect_events(t.spark, feed, target, _folders(t, "events")[1]).awaitTermination()
    return t.spark.read.schema("id string").parquet(target).select("id")


@query(f"""WITH {WINDOWS}, e AS (SELECT max(start_time) - 600 AS watermark FROM {{motion}} WHERE motion >= 0.3)
SELECT camera, start, "end"::DOUBLE AS "end", peak_motion, buckets FROM w, e WHERE "end" + 600 <= watermark""")
def r02_motion_windows(t):
    """Windows that the watermark has closed; those at the end of the stream stay open."""
    target, checkpoint = _folders(t, "windows")
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', cast(ts AS timestamp_ntz))")
    feed = _stream(t, "events").select(F.concat(F.lit("cam"), (F.col("user_id") % 40).cast("string")).alias("camera"), F.timestamp_seconds(seconds).alias("ts"), (F.col("value") / 490).alias("motion"))
    incremental.store_motion_windows(t.spark, incremental.motion_windows(feed, 0.3, 600), target, checkpoint).awaitTermination()
    return t.spark.read.schema("camera string, start double, end double, peak_motion double, buckets long").parquet(target).drop("_batch")


@query(f"""WITH {DECIDED}, asked AS (SELECT concat('a', o_orderkey, '-1') AS object_id FROM {{orders}})
SELECT object_id, coalesce(d.status, 'DROP') AS status, CASE WHEN d.object_id IS NULL THEN 'sam_failure' ELSE reason END AS reason FROM asked LEFT JOIN d USING (object_id)""")
def r03_audit_objects(t):
    """Objects decided as they come, twice: final decisions are not made again."""
    target, checkpoint = _folders(t, "audit")
    segments = t.segments.withColumn("seg_box", boxes.box("x1", "y1", "x2", "y2"))
    keys = {"sample_hash": "h", "sam_key": "s", "vlm_key": "v", "pipeline_version": "1", "feed_label": "x"}
    for _ in range(2):
        feed = _stream(t, "orders").select(F.concat(F.lit("a"), "o_orderkey", F.lit("-1")).alias("object_id"), *[F.lit(v).alias(k) for k, v in keys.items()])
        incremental.audit_objects(t.spark, feed, segments, t.verdicts, target, checkpoint, vocabulary=["person", "car", "dog", "cat"]).awaitTermination()
    return t.spark.read.schema("object_id string, status string, reason string").parquet(target).drop("_batch")


@query(f"""WITH {DECIDED} SELECT a.id AS object_id, coalesce(d.status, 'DROP') AS status, CASE WHEN d.object_id IS NULL THEN 'sam_failure' ELSE reason END AS reason,
 CASE WHEN d.object_id IS NULL OR (d.status = 'PENDING' AND a.id LIKE '%1') THEN 1 ELSE 0 END AS attempt, substr(a.created_at, 1, 7) AS day FROM {{annotations}} a LEFT JOIN d ON d.object_id = a.id""")
def r03_audit_states(t):
    """Objects, segments and verdicts as three streams, the verdicts in two parts with a restart between them. An object without a segment is decided by its timer in
    the second run, in which those that are pending since the first are tried again. Objects are stored by month."""
    target, checkpoint = _folders(t, "audit")
    objects = written(t.annotations.select(F.col("id").alias("object_id"), F.col("label").alias("feed_label"), F.substring("created_at", 1, 7).alias("day")))
    segments = written(t.segments.select("object_id", "seg_class", boxes.box("x1", "y1", "x2", "y2").alias("seg_box"), F.col("seg_area").cast("double").alias("seg_area")))
    verdicts, folder = t.verdicts, _folders(t, "verdicts")[0]
    keys = {k: F.lit("1") for k in ("sample_hash", "sam_key", "vlm_key", "pipeline_version")}
    buckets = max(64, objects.count() // 128)
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")

    def feed(df, path):
        return t.spark.readStream.schema(df.schema).parquet(path).withColumn("at", at)

    for first in (True, False):
        part = F.col("object_id").like("%1")
        verdicts.where(part if first else ~part).write.mode("append").parquet(folder)
        streams = feed(objects, objects.written_path).withColumns(keys), feed(segments, segments.written_path), feed(verdicts, folder)
        audit.audit_states(t.spark, *streams, target, checkpoint, "1 millisecond", ["person", "car", "dog", "cat"], buckets=buckets).awaitTermination()
    discard(objects, segments)
    return store.Store(t.spark, target, "day").read().select("object_id", "status", "reason", "attempt", "day")
