"""Updates as functions from tables to tables, and on stored tables, where only the partitions that change are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import written
from .pool import VERDICTS
from .store import Store

ANNOTATION = ("id", "sample_id", "event_id", "source", "label", "x1", "y1", "x2", "y2", "confidence", "verified", "created_at")


def set_quality(samples: DataFrame, ids: DataFrame, verdict: str | None) -> tuple[DataFrame, DataFrame]:
    """(samples with the verdict set or cleared for the ids, one row with the number changed)."""
    if verdict is not None and verdict not in VERDICTS:
        raise ValueError(f"unknown verdict {verdict!r}")
    marked = samples.join(ids.select("id").distinct().withColumn("_hit", F.lit(True)), "id", "left")
    changed = F.coalesce("_hit", F.lit(False)) & ~F.col("quality").eqNullSafe(F.lit(verdict))
    count = marked.agg(F.count_if(changed).alias("changed"))
    return marked.withColumn("quality", F.when(F.col("_hit"), F.lit(verdict)).otherwise(F.col("quality"))).select(*samples.columns), count


def store_verified(samples: DataFrame, annotations: DataFrame, results: DataFrame, labels: list[str] | None = None, mode: str = "append", now: str = "1970-01-01T00:00:00") -> tuple[DataFrame, DataFrame]:
    """(samples, annotations) after verification. ``results`` has sample_id, objects (array of structs), only ok rows.

    Accepted labels become annotations of source vlm, verified; the sample counts as verified even without any. ``mode``
    "replace" removes the sample's earlier vlm rows.
    """
    found = results.select("sample_id", F.posexplode("objects").alias("n", "o")).select("sample_id", "n", "o.*")
    if labels:
        found = found.where(F.col("label").isin(labels))
    rows = found.select(F.concat("sample_id", F.lit("-vlm-"), F.lit(now), F.lit("-"), F.col("n").cast("string")).alias("id"), "sample_id", F.lit(None).cast("string").alias("event_id"), F.lit("vlm").alias("source"), "label", "x1", "y1", "x2", "y2", "confidence", F.lit(1).alias("verified"), F.lit(now).alias("created_at"))
    kept = annotations
    if mode == "replace":
        kept = annotations.join(results.select("sample_id", F.lit("vlm").alias("source")), ["sample_id", "source"], "left_anti").select(*annotations.columns)
    done = samples.join(results.select(F.col("sample_id").alias("id")).distinct().withColumn("_hit", F.lit(1)), "id", "left")
    return done.withColumn("verified", F.coalesce("_hit", "verified")).select(*samples.columns), kept.unionByName(rows.select(*[c for c in annotations.columns]))


def drop_rejected(samples: DataFrame, results: DataFrame) -> DataFrame:
    """Samples whose answer was rejected become bad; transport failures change nothing."""
    bad = results.where("status = 'rejected'").select(F.col("sample_id").alias("id")).distinct().withColumn("_bad", F.lit(True))
    return samples.join(bad, "id", "left").withColumn("quality", F.when(F.col("_bad"), "bad").otherwise(F.col("quality"))).select(*samples.columns)


def verify_summary(results: DataFrame) -> DataFrame:
    """processed, annotated, skipped, failed, dropped and objects of a verification run."""
    n = F.coalesce(F.size("objects"), F.lit(0))
    return results.agg(
        F.count(F.lit(1)).alias("processed"), F.count_if((F.col("status") == "ok") & (n > 0)).alias("annotated"), F.count_if((F.col("status") == "ok") & (n <= 0)).alias("skipped"),
        F.count_if(F.col("status") == "transport").alias("failed"), F.count_if(F.col("status") == "rejected").alias("dropped"), F.coalesce(F.sum(F.when(F.col("status") == "ok", F.greatest(n, F.lit(0)))), F.lit(0)).alias("objects"),
    )


def delete_events(samples: DataFrame, annotations: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Removes the events' annotations, and the samples that they own and that have none left."""
    # hash joins: a task holds its share of the events (below, of the samples they own) and sorts nothing
    gone = events.select("event_id").distinct().hint("shuffle_hash")
    rest = annotations.join(gone, "event_id", "left_anti").select(*annotations.columns)
    owned = samples.join(gone, "event_id", "left_semi").select("id")
    alive = rest.select(F.col("sample_id").alias("id")).join(owned.hint("shuffle_hash"), "id", "left_semi")
    owners = owned.join(alive.hint("shuffle_hash"), "id", "left_anti")
    return samples.join(owners.hint("shuffle_hash"), "id", "left_anti").select(*samples.columns), rest


def deployment_rows(gated: DataFrame, version: str, now: str) -> DataFrame:
    """Rows for the deployment ledger from gate results."""
    metrics = F.to_json(F.struct("map50", "recall", "fp_rate", "latency_ms", "cpu_percent"))
    return gated.select(F.concat_ws("-", "name", F.lit(version), F.lit(now)).alias("id"), F.col("name").alias("model_name"), F.lit(version).alias("version"), metrics.alias("metrics_json"), F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("verdict"), F.to_json("reasons").alias("reasons_json"), F.lit(now).alias("created_at"))


def failure_rows(failed: DataFrame, now: str, most: int = 2000) -> DataFrame:
    """Rows for the failure ledger, error texts cut to ``most`` characters. Failed events stay collectable: they are in no other table."""
    return failed.select("event_id", "camera", F.substring("error", 1, most).alias("error"), F.lit(now).alias("created_at"))


def upsert_overrides(overrides: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(latest override per object, rejected changes with reason)."""
    reason = F.when(F.length(F.trim(F.coalesce("object_id", F.lit("")))) == 0, "missing_id").when(~F.coalesce(F.col("status").isin("KEEP", "DROP"), F.lit(False)), "bad_status")
    checked = changes.withColumn("reason", reason)
    w = Window.partitionBy("object_id").orderBy(F.desc("updated_at"), "status")
    merged = overrides.unionByName(checked.where("reason is null").drop("reason")).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return merged, checked.where("reason is not null")


def remove_overrides(overrides: DataFrame, ids: DataFrame) -> DataFrame:
    return overrides.join(ids.select("object_id"), "object_id", "left_anti")


# --- the same on stored tables: only the partitions with a changed row are written

#: Cells of 64 bits in a filter of keys at most (some 20 MB where it is broadcast); a fuller filter lets more rows through to the join and changes no result.
FILTER_CELLS = 1 << 19


def _without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key is not in the written table ``gone``. Rows that a filter of these keys rules out are not shuffled, only the others meet ``gone``."""
    cells = min(FILTER_CELLS, max(64, 1 << (gone.count() // 4).bit_length()))
    h = F.xxhash64(key)
    cell = h.bitwiseAND(F.lit(cells - 1).cast("long")).alias("_cell")
    one = lambda shift: F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({key}), {shift}) & 63 as int))")
    mask = one(40).bitwiseOR(one(46))
    known = written(gone.select(cell, mask.alias("_mask")).groupBy("_cell").agg(F.bit_or("_mask").alias("_bits")))
    met = rows.withColumn("_cell", cell).join(F.broadcast(known), "_cell", "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))
    left = met.where(maybe).select(*rows.columns).join(gone.select(key).hint("merge"), key, "left_anti")
    return met.where(~maybe).select(*rows.columns).union(left.select(*rows.columns))


def set_quality_stored(samples: Store, ids: DataFrame, verdict: str | None) -> list[str]:
    """``set_quality`` in place; returns the partitions written. Samples that have the verdict already are not written again."""
    if verdict is not None and verdict not in VERDICTS:
        raise ValueError(f"unknown verdict {verdict!r}")
    wanted = written(ids.select("id").distinct())
    stale = samples.read().where(~F.col("quality").eqNullSafe(F.lit(verdict))).select("id", samples.by)
    return samples.rewrite(stale.join(wanted.hint("merge"), "id", "left_semi"), lambda rows: set_quality(rows, wanted, verdict)[0])


def delete_events_stored(samples: Store, annotations: Store, events: DataFrame) -> tuple[list[str], list[str]]:
    """``delete_events`` in place: (partitions of samples, partitions of annotations) that were written.

    Samples go first: if a run ends between the two writes, its repetition finds the annotations and does the rest.
    """
    gone = written(events.select("event_id").where("event_id is not null").distinct())
    rest = annotations.read().join(gone.hint("merge"), "event_id", "left_anti").select(F.col("sample_id").alias("id"))
    owners = samples.read().join(gone.hint("merge"), "event_id", "left_semi").select("id", samples.by).join(rest.hint("merge"), "id", "left_anti")
    owners = written(owners)
    without = samples.rewrite(owners, lambda rows: _without(rows, owners, "id"))
    theirs = annotations.read().join(gone.hint("merge"), "event_id", "left_semi").select(annotations.by)
    return without, annotations.rewrite(theirs, lambda rows: _without(rows, gone, "event_id"))


def store_verified_stored(samples: Store, annotations: Store, results: DataFrame, labels: list[str] | None = None, mode: str = "append", now: str = "1970-01-01T00:00:00", by=None) -> tuple[list[str], list[str]]:
    """``store_verified`` in place: (partitions of samples, partitions of annotations) that were written. ``by`` gives a new annotation's partition from its columns;
    a run that is repeated replaces its own annotations, which carry its time in their ids."""
    results = written(results)
    asked = results.select(F.col("sample_id").alias("id")).distinct()
    stale = samples.read().where(~F.col("verified").eqNullSafe(F.lit(1))).select("id", samples.by)
    done = samples.rewrite(stale.join(asked.hint("merge"), "id", "left_semi"), lambda rows: store_verified(rows, rows.limit(0).select(*[F.lit(None).cast("string").alias(c) for c in ANNOTATION]), results, labels, "append", now)[0])
    names = [c for c in annotations.read().columns if c != annotations.by]
    none = annotations.read().limit(0).select(*names)
    fresh = written(store_verified(samples.read().limit(0), none, results, labels, "append", now)[1].withColumn(annotations.by, by))
    old = annotations.read().where("source = 'vlm'").join(results.select("sample_id").distinct().hint("merge"), "sample_id", "left_semi")
    gone = old if mode == "replace" else old.join(fresh.select("id").hint("merge"), "id", "left_semi")
    gone = written(gone.select("id", annotations.by))
    touched = fresh.select(annotations.by).union(gone.select(annotations.by))
    return done, annotations.rewrite(touched, lambda rows: _without(rows, gone, "id").unionByName(fresh))


def upsert_overrides_stored(overrides: Store, changes: DataFrame, by) -> tuple[list[str], DataFrame]:
    """``upsert_overrides`` in place: (partitions written, rejected changes with reason). ``by`` gives an object's partition from its id."""
    fresh = written(changes.withColumn(overrides.by, by))
    accepted = upsert_overrides(fresh.limit(0), fresh)[0]
    return overrides.rewrite(accepted, lambda rows: upsert_overrides(rows, fresh)[0]), upsert_overrides(fresh.limit(0), fresh)[1]
