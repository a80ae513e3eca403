"""Detection tables derived from the star schema, once as text for both engines.

``{name}`` stands for a base table or an earlier view; ``<<...>>`` marks the few expressions that the dialects spell
differently. Everything is integer and string arithmetic on the rows themselves, so the views grow with the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: name: (Spark, DuckDB)
DIALECT = {
    "epoch": ("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', cast({0} as timestamp_ntz))", "cast(floor(epoch({0})) as bigint)"),
    "iso": ("date_format(cast({0} as timestamp_ntz), \"yyyy-MM-dd'T'HH:mm:ss\")", "strftime({0}, '%Y-%m-%dT%H:%M:%S')"),
    "str": ("cast({0} as string)", "cast({0} as varchar)"),
    "list": ("array({0})", "[{0}]"),
    "int": ("cast(floor({0}) as int)", "cast(floor({0}) as int)"),
}

VIEWS: dict[str, str] = {
    "samples": """
SELECT concat('s', <<str:o_orderkey>>) AS id, concat('cam', <<str:o_custkey % 20>>) AS camera,
       cast(<<epoch:o_orderdate>> AS double) AS ts, concat('e', <<str:o_orderkey>>) AS event_id, 0 AS frame_index,
       concat('img/', <<str:o_orderkey % 1000>>, '.jpg') AS image_path,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('h', <<str:o_custkey * 31 % 997>>) END AS image_hash,
       CASE WHEN o_orderstatus <> 'P' THEN 'collected' ELSE 'imported' END AS status,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'useful' WHEN '2' THEN 'bad' WHEN '3' THEN 'duplicate' WHEN '4' THEN 'ignore' END AS quality,
       CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS verified,
       CASE o_orderkey % 4 WHEN 0 THEN 'person' WHEN 1 THEN 'car' WHEN 2 THEN 'dog' END AS feed_label,
       <<iso:o_orderdate>> AS created_at
FROM {orders}""",
    "annotations": """
SELECT concat('a', <<str:l_orderkey>>, '-', <<str:n>>) AS id, concat('s', <<str:l_orderkey>>) AS sample_id,
       concat('e', <<str:l_orderkey>>) AS event_id,
       CASE l_suppkey % 4 WHEN 0 THEN 'feed' WHEN 1 THEN 'vlm' WHEN 2 THEN 'human' ELSE 'external' END AS source,
       CASE l_returnflag WHEN 'A' THEN 'person' WHEN 'N' THEN 'car' WHEN 'R' THEN 'dog' ELSE '' END AS label,
       x1, y1, CASE WHEN l_partkey % 17 = 0 THEN x1 ELSE least(cast(1 AS double), x1 + (1 + <<int:l_quantity>> % 40) / cast(100 AS double)) END AS x2,
       CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE least(cast(1 AS double), y1 + (1 + l_linenumber * 5) / cast(100 AS double)) END AS y2,
       1 - l_discount AS confidence, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS verified, <<iso:l_shipdate>> AS created_at
FROM (SELECT *, (l_partkey % 50) / cast(100 AS double) AS x1, (l_suppkey % 50) / cast(100 AS double) AS y1,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS n
      FROM {lineitem})""",
    "motion": """
SELECT concat('cam', <<str:user_id % 40>>) AS camera, <<epoch:ts>> AS start_time, value / 490 AS motion FROM {events}""",
    "event_feed": """
SELECT concat('e', <<str:o_orderkey>>) AS id, concat('cam', <<str:o_custkey % 20>>) AS camera,
       CASE o_orderkey % 3 WHEN 0 THEN 'person' WHEN 1 THEN 'car' ELSE 'dog' END AS label, cast(<<epoch:o_orderdate>> AS double) AS start_time,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE cast(<<epoch:o_orderdate>> AS double) + o_custkey % 90 END AS end_time,
       <<list:(o_custkey % 60) / cast(100 AS double), (o_orderkey % 60) / cast(100 AS double), (o_custkey % 7) / cast(20 AS double), (o_orderkey % 9) / cast(30 AS double)>> AS box
FROM {orders}""",
    "segments": """
SELECT a.id AS object_id, a.sample_id, a.label AS feed_label, a.x1, a.y1, a.x2, a.y2,
       CASE WHEN k % 9 = 0 THEN NULL WHEN k % 13 = 0 THEN 'cat' ELSE a.label END AS seg_class,
       CASE WHEN k % 7 = 0 THEN 0 ELSE 40 + k % 50 END AS seg_area, k
FROM (SELECT *, length(id) * 7 + <<int:confidence * 100>> + <<int:x1 * 100>> AS k FROM {annotations} WHERE y2 IS NOT NULL AND x2 > x1 AND y2 > y1) a""",
    "verdicts": """
SELECT object_id, CASE WHEN k % 8 = 1 THEN NULL ELSE k % 6 <> 0 END AS covers,
       CASE WHEN k % 8 = 1 THEN NULL WHEN k % 10 = 3 THEN '' WHEN k % 10 = 4 THEN 'Human' ELSE feed_label END AS vlm_label,
       CASE WHEN k % 8 = 1 THEN CASE WHEN k % 3 = 0 THEN 'transport' WHEN k % 3 = 1 THEN 'malformed' ELSE 'failure' END END AS vlm_error
FROM {segments}""",
    "overrides": """
SELECT id AS object_id, CASE WHEN k % 101 = 0 THEN 'KEEP' WHEN k % 101 = 1 THEN 'DROP' ELSE 'MAYBE' END AS status
FROM (SELECT id, length(id) + <<int:x1 * 100>> * 3 + <<int:confidence * 100>> AS k FROM {annotations}) WHERE k % 101 < 3""",
    "candidates": """
SELECT s_name AS name, concat('v', <<str:s_suppkey % 5>>) AS version, abs(s_acctbal) / 10000 AS map50,
       (s_suppkey * 37 % 100) / cast(100 AS double) AS recall, (s_suppkey * 53 % 100) / cast(400 AS double) AS fp_rate,
       CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 10 = 1 THEN 0 ELSE (s_suppkey * 29 % 400) / cast(10 AS double) END AS latency_ms,
       CASE WHEN s_suppkey % 4 = 0 THEN (s_suppkey * 17 % 120) / cast(1 AS double) END AS cpu_percent
FROM {supplier}""",
    "curves": """
SELECT concat(lower(replace(p_brand, '#', '')), '-', lower(substr(p_type, 1, 3))) AS run, p_size AS epoch,
       CASE p_partkey % 20 WHEN 0 THEN 'nan' WHEN 1 THEN 'inf' WHEN 2 THEN '' ELSE <<str:p_retailprice / 2000>> END AS map50
FROM {part}""",
    "truths": """
SELECT <<str:l_suppkey % 4>> AS candidate, sample_id AS image_id, label, id AS truth_id, x1, y1, x2, y2
FROM (SELECT a.*, l_suppkey FROM {annotations} a JOIN (SELECT DISTINCT concat('s', <<str:l_orderkey>>) AS sid, min(l_suppkey) AS l_suppkey FROM {lineitem} GROUP BY l_orderkey) k ON k.sid = a.sample_id)
WHERE verified = 1 AND x2 > x1 AND y2 > y1""",
    "predictions": """
SELECT <<str:l_suppkey % 4>> AS candidate, sample_id AS image_id, label, id AS prediction_id, confidence,
       x1 + dx AS x1, y1 AS y1, x2 + dx AS x2, y2 AS y2
FROM (SELECT a.*, l_suppkey, ((length(id) + <<int:x1 * 100>>) % 5 - 2) / cast(100 AS double) AS dx FROM {annotations} a
      JOIN (SELECT concat('s', <<str:l_orderkey>>) AS sid, min(l_suppkey) AS l_suppkey FROM {lineitem} GROUP BY l_orderkey) k ON k.sid = a.sample_id)
WHERE x2 > x1 AND y2 > y1""",
    "responses": """
SELECT concat('r', <<str:l_orderkey>>, '-', <<str:l_linenumber>>, '-', <<str:l_partkey>>) AS id, l_orderkey AS run_order, l_orderkey % 50 AS batch,
       CASE WHEN l_partkey % 10 = 9 THEN NULL
            WHEN l_partkey % 10 = 8 THEN concat('Sure! ', body, ' Hope that helps.')
            WHEN l_partkey % 10 = 7 THEN concat('```json', chr(10), body, chr(10), '```')
            WHEN l_partkey % 10 = 6 THEN replace(body, '"confidence": 0.', '"confidence": 7.')
            WHEN l_partkey % 10 = 5 THEN replace(body, '"label"', '"name"')
            WHEN l_partkey % 10 = 4 THEN 'no json here' ELSE body END AS content
FROM (SELECT *, concat('{{"objects": [{{"label": "', CASE l_returnflag WHEN 'A' THEN 'person' WHEN 'N' THEN 'car' ELSE 'dragon' END,
             '", "confidence": 0.', <<str:10 + l_linenumber>>, ', "bbox": [0.', <<str:10 + l_partkey % 40>>, ', 0.2, 0.', <<str:30 + l_suppkey % 60>>, ', 0.9]}}]}}') AS body
      FROM {lineitem})""",
    "reviews": """
SELECT concat('v', <<str:o_orderkey % 5000>>) AS id, concat('cam', <<str:o_custkey % 20>>) AS camera,
       CASE WHEN o_orderkey % 3 = 0 THEN 'alert' ELSE 'detection' END AS severity, cast(<<epoch:o_orderdate>> AS double) AS start_time,
       cast(<<epoch:o_orderdate>> AS double) + 60 AS end_time, <<list:concat('z', <<str:o_custkey % 3>>)>> AS zones,
       <<list:concat('e', <<str:o_orderkey>>), concat('e', <<str:o_orderkey + 1>>)>> AS detections
FROM {orders}""",
}

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _dialect(text: str, engine: int) -> str:
    pattern = re.compile(r"<<(\w+):((?:(?!<<|>>).)*)>>", re.S)
    while pattern.search(text):
        text = pattern.sub(lambda m: DIALECT[m[1]][engine].replace("{0}", m[2]), text)
    return text


def _needs(text: str) -> list[str]:
    return [n for n in re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text)]


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or derived view."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = _dialect(VIEWS[name], 0)
    return spark.sql(text, **{n: spark_view(spark, sf_dir, n) for n in set(_needs(text))})


def duck_sql(body: str) -> str:
    """A DuckDB statement over the views that ``body`` names as {view}, as common table expressions."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in order:
            for n in _needs(VIEWS[name]):
                visit(n)
            order.append(name)

    for n in _needs(body):
        visit(n)

    def flat(text: str) -> str:
        return re.sub(r"(?<!\{)\{(\w+)\}(?!\})", r"\1", _dialect(text, 1)).replace("{{", "{").replace("}}", "}")

    ctes = ",\n".join(f"{n} AS ({flat(VIEWS[n])})" for n in order)
    text = flat(body).strip()
    if not ctes:
        return text
    if text.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{text[15:]}"
    return f"WITH {ctes},\n{text[5:]}" if text.upper().startswith("WITH ") else f"WITH {ctes}\n{text}"
