"""COCO files, audit manifests, label files, manifests, class tables, decisions and dataset versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions import boxes
from ..lineage import join_counted, written
from ..operators import ranges


def import_coco(files: DataFrame, classes: list[str], class_map: dict[str, str] | None = None, present: DataFrame | None = None, source: str = "external") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(samples, annotations, one-row summary) from COCO records: images x annotations x categories.

    Categories are renamed by ``class_map`` and kept if configured. An image without file or mapped object is left out; sizes are
    1920 x 1080 by default; the first mapped object names the sample. Annotations count as verified, samples do not.
    """
    images = files.select(F.explode("images").alias("i")).select(F.col("i.id").alias("image_id"), "i.file_name", F.coalesce("i.width", F.lit(1920)).alias("w"), F.coalesce("i.height", F.lit(1080)).alias("h"))
    found = files.select(F.posexplode("annotations").alias("pos", "a")).select("pos", F.col("a.id").alias("ann_id"), "a.image_id", "a.category_id", "a.bbox", F.coalesce(F.nullif(F.col("a.score"), F.lit(0.0)), F.lit(1.0)).alias("confidence"))
    names = files.select(F.explode("categories").alias("c")).select(F.col("c.id").alias("category_id"), F.col("c.name").alias("name"))
    renamed = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in class_map.items() for x in kv]), F.col("name")), F.col("name")) if class_map else F.col("name")
    names = names.select("category_id", F.when(renamed.isin(classes), renamed).alias("label"))
    objects = join_counted(found, names, "category_id", "left").join(images.hint("merge"), "image_id").withColumn("box", boxes.coco_box(F.col("bbox"), F.col("w"), F.col("h")))
    mapped = objects.where("label is not null and box is not null")
    here = images.join(present.select("file_name"), "file_name", "left_semi") if present is not None else images
    first = mapped.groupBy("image_id").agg(F.min_by("label", "pos").alias("feed_label"))
    samples = here.join(first.hint("merge"), "image_id").select(F.concat(F.lit(f"{source}-"), F.col("image_id").cast("string")).alias("id"), F.col("file_name").alias("image_path"), "feed_label", F.lit(0).alias("verified"))
    kept = mapped.join(samples.select(F.col("image_path").alias("file_name")).hint("merge"), "file_name", "left_semi")
    annotations = kept.select(F.concat(F.lit(f"{source}-a"), F.col("ann_id").cast("string")).alias("id"), F.concat(F.lit(f"{source}-"), F.col("image_id").cast("string")).alias("sample_id"), F.lit(source).alias("source"), "label", "box.*", "confidence", F.lit(1).alias("verified"))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    summary = count(images, "images").crossJoin(count(found, "objects")).crossJoin(count(objects.where("label is null or box is null"), "skipped_unmapped")).crossJoin(count(samples, "written"))
    missing = count(images.join(here.select("image_id").hint("merge"), "image_id", "left_anti"), "skipped_missing")
    return samples, annotations, summary.crossJoin(missing)  # one row each


def read_coco(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.COCO).option("multiLine", True).json(path)


def read_audit_manifest(spark: SparkSession, path: str, width: int = 1920, height: int = 1080) -> tuple[DataFrame, DataFrame]:
    return parse_audit_manifest(spark.read.schema(schemas.AUDIT_MANIFEST).option("multiLine", True).json(path), width, height)


def parse_audit_manifest(raw: DataFrame, width: int = 1920, height: int = 1080) -> tuple[DataFrame, DataFrame]:
    """(objects, rejects with reason): file-level defaults with per-object overrides, class ids from class_map or by first appearance."""
    o = raw.select("*", F.posexplode("objects").alias("manifest_index", "o"))
    pick = lambda f, d: F.coalesce(F.col(f"o.{f}"), F.col(f), F.lit(d) if d is not None else F.lit(None))
    origin = F.struct(F.get("o.crop_origin", F.lit(0)).alias("x"), F.get("o.crop_origin", F.lit(1)).alias("y"))
    size = F.coalesce("o.frame_size", "frame_size")
    frame = F.struct(F.get(size, F.lit(0)).alias("w"), F.get(size, F.lit(1)).alias("h"))
    box, bad = boxes.declared_box(F.col("o.bbox"), pick("bbox_format", "xyxy"), pick("normalized", False), pick("coordinate_space", "image"), F.coalesce("o.width", F.lit(float(width))), F.coalesce("o.height", F.lit(float(height))), origin, frame)
    out = o.withColumns({"box": box, "bad": bad, "_copy": F.row_number().over(Window.partitionBy("o.id", F.when(F.col("o.id").isNull(), F.col("manifest_index"))).orderBy("manifest_index"))})
    reason = F.when(F.col("o.id").isNull(), "missing_id").when(F.col("o.class_name").isNull(), "missing_class").when(F.col("o.image").isNull(), "missing_image").when(F.col("_copy") > 1, "duplicate_id").otherwise(F.col("bad"))
    out = out.withColumn("reason", reason)
    root = pick("image_root", "")
    image = F.when(F.length(root) > 0, F.concat_ws("/", root, "o.image")).otherwise(F.col("o.image"))
    mapped = F.when(F.col("reason").isNull(), F.element_at("class_map", F.col("o.class_name")))
    # read three times below: the manifests are taken apart once
    out = written(out.select(F.col("o.id").alias("object_id"), image.alias("image_path"), F.col("o.class_name").alias("class_name"), mapped.alias("mapped"), "box", "manifest_index", F.col("o.crop_origin").alias("crop_origin"), "reason"))
    first = out.where("reason is null").groupBy(F.col("class_name").alias("name")).agg(F.min("manifest_index").alias("_f"))
    order = ranges.ranked(written(first), [], [F.asc("_f"), F.asc("name")], "_place").select("name", (F.col("_place") - 1).cast("int").alias("seen_id"))
    good = join_counted(out.where("reason is null"), order, F.col("class_name") == F.col("name"))
    objects = good.select("object_id", "image_path", "class_name", F.coalesce("mapped", "seen_id").alias("class_id"), "box", "manifest_index", "crop_origin")
    return objects, out.where("reason is not null").select("object_id", "manifest_index", "reason")


def list_images(spark: SparkSession, path: str) -> DataFrame:
    """path, length and the hash of each file's bytes."""
    return image_hashes(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path))


def image_hashes(files: DataFrame) -> DataFrame:
    """path, length and content hash of files (path, length, content)."""
    return files.select("path", "length", F.sha2("content", 256).alias("content_hash"))


def existing(rows: DataFrame, images: DataFrame, column: str = "image_path") -> DataFrame:
    return rows.join(images.select(F.col("path").alias(column)), column, "left_semi")


def parse_labels(lines: DataFrame, classes: int) -> DataFrame:
    """Adds class_id, cx, cy, w, h and valid to label lines (file, line_no, value); blank lines go. Valid: five numbers, a known class, positive
    sizes, the centre within the unit square."""
    p = F.split(F.trim("value"), r"\s+")
    n = {k: F.get(p, F.lit(i)).try_cast("double") for i, k in enumerate(("class_id", "cx", "cy", "w", "h"))}
    out = lines.where("length(trim(value)) > 0").withColumns({**{k: v for k, v in n.items() if k != "class_id"}, "class_id": F.get(p, F.lit(0)).try_cast("int"), "_n": F.size(p)})
    ok = (F.col("_n") == 5) & F.col("class_id").between(0, classes - 1) & (F.col("w") > 0) & (F.col("h") > 0) & F.col("cx").between(0, 1) & F.col("cy").between(0, 1)
    return out.withColumn("valid", F.coalesce(ok, F.lit(False))).drop("_n")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no from 0, value) of text files, which are read in parts by many tasks, however large one is.

    Lines are numbered within the part of the file where they were read; the parts' counts, added up by offset, do the rest. Lines end
    with a line feed; the end of the file is no line.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_row"))
    lines = written(raw)
    parts = lines.groupBy(F.col("file").alias("_f"), F.col("_at").alias("_a")).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy("_f").orderBy("_a").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_f", "_a", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    met = join_counted(lines, parts, (F.col("file") == F.col("_f")) & (F.col("_at") == F.col("_a")))
    return met.select("file", (F.col("_before") + F.col("_row") - F.col("_first")).alias("line_no"), "value")


def read_labels(spark: SparkSession, path: str, classes: int) -> DataFrame:
    return parse_labels(numbered_lines(spark, path), classes)


def write_labels(bodies: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """(sample_id, split, body) as Parquet by split; an empty body stays."""
    bodies.select("sample_id", "split", F.coalesce("body", F.lit("")).alias("body")).write.mode(mode).partitionBy("split").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).json(path)


def append_manifest(existing_rows: DataFrame, rows: DataFrame, allow_overwrite: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows to append, rejects with reason): no missing, known or repeated sample_id, unless overwriting is allowed."""
    copies = rows.where("sample_id is not null").groupBy("sample_id").agg(F.count(F.lit(1)).alias("_n"))
    known = rows.join(existing_rows.select("sample_id").distinct().withColumn("_known", F.lit(True)).hint("merge"), "sample_id", "left").join(copies.hint("merge"), "sample_id", "left")
    reason = F.when(F.col("sample_id").isNull(), "missing_id").when(F.lit(not allow_overwrite) & (F.col("_known") | (F.col("_n") > 1)), "duplicate_id")
    out = known.withColumn("reason", reason)
    return out.where("reason is null").select(*rows.columns), out.where("reason is not null").select(*rows.columns, "reason")


def read_class_names(spark: SparkSession, path: str) -> DataFrame:
    """(class_id, label) from ``id: name`` lines of a dataset file, or from plain lines by number."""
    return parse_class_lines(numbered_lines(spark, path).select(F.col("line_no").cast("int").alias("n"), "value"), path.endswith((".yaml", ".yml")))


def parse_class_names(texts: DataFrame, keyed_lines: bool) -> DataFrame:
    """(class_id, label) from whole texts (value) with a class a line."""
    return parse_class_lines(texts.select(F.posexplode(F.split(F.rtrim("value"), "\n")).alias("n", "value")), keyed_lines)


def parse_class_lines(numbered: DataFrame, keyed_lines: bool) -> DataFrame:
    """(class_id, label) from lines (n, value)."""
    lines = numbered.where("length(trim(value)) > 0")
    keyed = lines.select(F.regexp_extract("value", r"^\s*(\d+):\s*['\"]?(.*?)['\"]?\s*$", 1).try_cast("int").alias("class_id"), F.regexp_extract("value", r"^\s*(\d+):\s*['\"]?(.*?)['\"]?\s*$", 2).alias("label")).where("class_id is not null")
    return keyed if keyed_lines else lines.select(F.col("n").alias("class_id"), F.trim("value").alias("label"))


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Decision files, one JSON object each; unreadable ones are skipped. extra holds the source's other fields."""
    return parse_decisions(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value"))


def parse_decisions(texts: DataFrame) -> DataFrame:
    """Decisions of texts (file, value)."""
    # a generator, through which the condition is not pushed: so a text is made and parsed once, not again for the condition
    raw = texts.select("file", F.explode(F.array(F.try_parse_json("value"))).alias("v")).where("v is not null and schema_of_variant(v) like 'OBJECT%'")
    get = lambda p, t="string": F.try_variant_get("v", p, t)
    fixed = ["sample_id", "class_name", "class_id", "image_path", "bbox"]
    extra = F.map_filter(get("$.provenance.source", "map<string,string>"), lambda k, _: ~k.isin(fixed))
    return raw.select(
        "file", F.coalesce(get("$.provenance.source.sample_id"), get("$.sample_id"), F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)).alias("object_id"), F.coalesce(get("$.provenance.source.class_name"), get("$.decision.feed_label")).alias("feed_label"),
        get("$.decision.status").alias("status"), get("$.decision.reason").alias("reason"), get("$.decision.failing_conditions", "array<string>").alias("failing_conditions"), get("$.decision.sam_class").alias("sam_class"), extra.alias("extra"),
    )


def read_provenance(spark: SparkSession, path: str) -> DataFrame:
    """One record per lookup key: sample_id, and source.sample_id where no record has that key itself; the first line wins."""
    return parse_provenance(numbered_lines(spark, path).select(F.struct("file", "line_no").alias("line"), "value"))


def parse_provenance(lines: DataFrame) -> DataFrame:
    """Records by lookup key from numbered lines (line, value)."""
    rows = lines.select("line", F.try_parse_json("value").alias("record")).where("record is not null")
    key = lambda p, n: rows.select(F.try_variant_get("record", p, "string").alias("key"), F.lit(n).alias("priority"), "line", F.to_json("record").alias("record"))
    both = key("$.sample_id", 0).union(key("$.source.sample_id", 1)).where("key is not null")
    w = Window.partitionBy("key").orderBy("priority", "line")
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("key", "record")


def read_curve(spark: SparkSession, path: str) -> DataFrame:
    """Training curves: every cell a number, else null for empty, nan and inf."""
    from ..operators.pool import curve_cells

    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).csv(path)
    return curve_cells(raw, raw.columns)


def read_benchmark(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Results of a benchmark file; ``lines`` if it has one result a line, as ``write_benchmark`` writes them, else it is taken as whole texts."""
    return parse_benchmark_lines(spark.read.text(path)) if lines else parse_benchmark(spark.read.text(path, wholetext=True))


def parse_benchmark(texts: DataFrame) -> DataFrame:
    """Results of whole texts (value); measures that are not there are null."""
    return texts.select(F.from_json("value", schemas.BENCHMARK)["results"].alias("r")).select(F.inline("r"))


def parse_benchmark_lines(lines: DataFrame) -> DataFrame:
    """Results of lines (value) with one result each, in any order; the object's first and last line have none."""
    kind = StructType.fromDDL(schemas.BENCHMARK)["results"].dataType.elementType
    return lines.where("value like '{%}' or value like ',{%}'").select(F.from_json(F.ltrim("value", F.lit(",")), kind).alias("r")).select("r.*")


def benchmark_lines(results: DataFrame) -> DataFrame:
    """(place, value): the lines of one JSON object with all results, one a line, in order of their text; every line but the first result begins with the comma."""
    each = ranges.ranked(results.select(F.to_json(F.struct(*results.columns)).alias("value")), [], [F.asc("value")], "place")
    body = each.select("place", F.concat(F.when(F.col("place") > 1, ",").otherwise(""), "value").alias("value"))
    ends = results.sparkSession.createDataFrame([(0, '{"results": ['), ((1 << 63) - 1, "]}")], "place long, value string")
    return body.union(ends)


def write_benchmark(results: DataFrame, path: str) -> None:
    """All results as one JSON object over the folder's files in order of their names; every measure is kept, the processor load too."""
    benchmark_lines(results).repartitionByRange("place").sortWithinPartitions("place").select("value").write.mode("overwrite").text(path)


def write_dataset(rows: DataFrame, summary: DataFrame, path: str, overwrite: bool = False, classes: DataFrame | None = None) -> None:
    """A dataset version: manifest by split, sorted split lists, class vocabulary (label, class_id) and a one-row summary; a version
    that exists is refused unless overwriting. A split's list is sorted across its files, in order of their names."""
    mode = "overwrite" if overwrite else "errorifexists"
    rows.write.mode(mode).partitionBy("split").json(f"{path}/manifest")
    lists = rows.select("split", F.col("sample_id").alias("value")).repartitionByRange("split", "value").sortWithinPartitions("split", "value")
    lists.write.mode(mode).partitionBy("split").text(f"{path}/lists")
    if classes is not None:
        classes.orderBy("class_id").select("class_id", "label").coalesce(1).write.mode(mode).json(f"{path}/classes")
    summary.coalesce(1).write.mode(mode).json(f"{path}/build")


def dataset_lists(rows: DataFrame) -> DataFrame:
    """(split, sample_id, place): the ids of every split in order. A split is ranked in parts, by a
    range sort: places within a range of ids, plus the ids of the ranges before."""
    ranged = written(rows.select("split", "sample_id").repartitionByRange("split", "sample_id").withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy("split", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("split").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("split", "_part").orderBy("sample_id")) - 1
    out = ranged.withColumn("_own", own).join(sums.select("split", "_part", before.alias("_before")).hint("merge"), ["split", "_part"])
    return out.select("split", "sample_id", (F.col("_own") + F.col("_before")).alias("place"))


def export_new(objects: DataFrame, exported: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(label bodies by frame, provenance lines) of the objects not exported yet; a second run adds nothing."""
    fresh = objects.join(exported.select("object_id"), "object_id", "left_anti")
    bodies = fresh.groupBy("frame_key").agg(F.array_join(F.sort_array(F.collect_list("label_line")), "\n").alias("body"))
    return bodies, fresh.select("object_id", F.to_json(F.struct(*fresh.columns)).alias("value"))
