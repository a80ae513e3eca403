"""Model output: strict checks of response texts, and the hook that applies a model to a table."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import boxes, labels
from ..lineage import spread

NUMBER = r"(BIGINT|DOUBLE|DECIMAL\(\d+,\d+\)|INT|SMALLINT|TINYINT|FLOAT)"


def parse_detections(responses: DataFrame, content: str = "content", allowed: list[str] | None = None) -> DataFrame:
    """Adds status (ok, rejected, transport), reason, messages and objects (label, confidence, x1, y1, x2, y2).

    An object or a bare list; every item has exactly label, confidence and bbox of the right types, a confidence within 0 to 1, a
    non-blank allowed label and a box that is not degenerate once clipped. One bad item rejects the response; a null response
    is a transport failure. The messages, five at most, are (item, problem): keys_or_types, label, confidence, bbox.
    """
    # each step is a column of its own, so that a text is parsed once and an item taken apart once
    out = spread(responses).withColumn("_body", labels.json_body(F.col(content))).withColumn("_v", F.try_parse_json(labels.json_part(F.col("_body"))))
    out = out.withColumn("_keys", F.map_keys(F.try_variant_get("_v", "$", "map<string,variant>")))
    alone = F.coalesce((F.size("_keys") == 1) & F.array_contains("_keys", "objects"), F.lit(False))
    items = F.coalesce(F.try_variant_get("_v", "$", "array<variant>"), F.when(alone, F.try_variant_get("_v", "$.objects", "array<variant>")))

    def taken_apart(x: Column) -> Column:
        return F.struct(
            F.schema_of_variant(x).alias("kind"), F.trim(F.try_variant_get(x, "$.label", "string")).alias("label"),
            F.try_variant_get(x, "$.confidence", "double").alias("confidence"), F.try_variant_get(x, "$.bbox", "array<double>").alias("bbox"),
        )

    def boxed(x: Column) -> Column:
        return F.struct(x["kind"].alias("kind"), x["label"].alias("label"), x["confidence"].alias("confidence"), F.size(x["bbox"]).alias("n"), boxes.clamped_model_box(boxes.from_xyxy(x["bbox"])).alias("box"))

    def problems(x: Column, i: Column) -> Column:
        # the exact shape also rules out further keys; of an item of another shape nothing else is said
        shape = F.coalesce(x["kind"].rlike(rf"^OBJECT<bbox: ARRAY<{NUMBER}>, confidence: {NUMBER}, label: STRING>$"), F.lit(False))
        known = F.length(x["label"]) > 0 if allowed is None else x["label"].isin(allowed) & (F.length(x["label"]) > 0)
        checks = (("label", known), ("confidence", x["confidence"].between(0, 1)), ("bbox", (x["n"] == 4) & x["box"].isNotNull()))
        found = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks]))
        found = F.when(~shape, F.array(F.lit("keys_or_types"))).otherwise(found)
        return F.transform(found, lambda p: F.struct(i.alias("item"), p.alias("problem")))

    out = out.withColumn("_items", F.transform(items, taken_apart)).withColumn("_items", F.transform("_items", boxed))
    out = out.withColumn("messages", F.slice(F.flatten(F.transform("_items", problems)), 1, 5))
    reason = F.when(F.col(content).isNull(), "transport").when(F.col("_items").isNull(), "no_objects").when(F.size("messages") > 0, "bad_object")
    out = out.withColumns({"reason": reason, "messages": F.coalesce("messages", F.array().cast("array<struct<item:int,problem:string>>"))})
    status = F.when(F.col("reason").isNull(), "ok").when(F.col("reason") == "transport", "transport").otherwise("rejected")
    kept = F.transform("_items", lambda x: F.struct(x["label"].alias("label"), x["confidence"].alias("confidence"), *[x["box"][k].alias(k) for k in ("x1", "y1", "x2", "y2")]))
    return out.withColumns({"status": status, "objects": F.when(F.col("reason").isNull(), kept)}).drop("_body", "_v", "_keys", "_items")


def parse_verdicts(responses: DataFrame, content: str = "content") -> DataFrame:
    """Adds covers, vlm_label and vlm_error from a JSON object with a boolean bbox_covers_object and a string class_label."""
    out = responses.withColumn("_v", F.try_parse_json(labels.json_text(F.col(content))))
    covers, name = F.try_variant_get("_v", "$.bbox_covers_object", "variant"), F.try_variant_get("_v", "$.class_label", "variant")
    out = out.withColumn("_ok", F.coalesce((F.schema_of_variant(covers) == "BOOLEAN") & (F.schema_of_variant(name) == "STRING"), F.lit(False)))
    return out.withColumns(
        {
            "covers": F.when(F.col("_ok"), F.try_variant_get("_v", "$.bbox_covers_object", "boolean")),
            "vlm_label": F.when(F.col("_ok"), F.trim(F.try_variant_get("_v", "$.class_label", "string"))),
            "vlm_error": F.when(F.col(content).isNull(), "transport").when(~F.col("_ok"), "malformed"),
        }
    ).drop("_v", "_ok")


def check_segments(responses: DataFrame) -> DataFrame:
    """Adds status and reason to segmenter rows: class_name, bbox (four numbers), mask runs, mask_w, mask_h, crop_w, crop_h, confidence."""
    b = boxes.from_xyxy(F.col("bbox"))
    reason = (
        F.when(F.length(F.trim(F.coalesce("class_name", F.lit("")))) == 0, "no_class")
        .when(~boxes.is_valid(b), "bad_bbox")
        .when(F.col("mask").isNull(), "no_mask")
        .when((F.col("mask_w") != F.col("crop_w")) | (F.col("mask_h") != F.col("crop_h")), "mask_size")
        .when(F.col("confidence").isNull() | F.isnan("confidence"), "bad_confidence")
    )
    return responses.withColumns({"reason": reason, "status": F.when(reason.isNull(), "ok").otherwise("rejected"), "box": b})


def score_table(df: DataFrame, make_model: Callable[[], Callable[[dict], dict]], columns: list[str], result: str) -> DataFrame:
    """Applies a user's model to rows: status (ok, rejected, transport), error, latency_ms and the result struct's fields.

    ``make_model`` is called once per partition and returns a function from a row's fields to a dict. A ValueError marks the row
    rejected, any other error a transport failure; other rows go on.
    """
    schema = StructType.fromDDL(f"{df.select(*columns)._jdf.schema().toDDL()}, status string, error string, latency_ms double, {result}")
    fields = [f.name for f in schema.fields][len(columns) + 3 :]

    def rows(batches) -> Iterator:
        import pandas as pd

        model = make_model()
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                begun, status, error, got = time.perf_counter(), "ok", None, {}
                try:
                    got = model(row)
                except ValueError as e:
                    status, error = "rejected", str(e)
                except Exception as e:  # noqa: BLE001  one row's failure must not end the others
                    status, error = "transport", str(e)
                out.append({**row, "status": status, "error": error, "latency_ms": (time.perf_counter() - begun) * 1e3, **{f: got.get(f) for f in fields}})
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return df.select(*columns).mapInPandas(rows, schema)
