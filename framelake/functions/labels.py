"""Column functions on labels, class tables and model output text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lineage import written
from ..operators import ranges
from .boxes import let

#: Synonyms of the canonical labels.
SYNONYMS: dict[str, tuple[str, ...]] = {
    "person": ("person", "people", "human", "man", "woman", "pedestrian"),
    "car": ("car", "sedan", "automobile", "suv", "pickup"),
    "bicycle": ("bicycle", "bike", "cycle"),
    "motorcycle": ("motorcycle", "motorbike", "motor bike"),
    "bird": ("bird",),
    "cat": ("cat", "kitty"),
    "dog": ("dog", "puppy"),
    "suitcase": ("suitcase", "luggage"),
}

#: The 80 detection classes in index order.
CLASSES_80 = (
    "person", "bicycle", "car", "motorcycle", "airplane", "bus", "train", "truck", "boat", "traffic light",
    "fire hydrant", "stop sign", "parking meter", "bench", "bird", "cat", "dog", "horse", "sheep", "cow",
    "elephant", "bear", "zebra", "giraffe", "backpack", "umbrella", "handbag", "tie", "suitcase", "frisbee",
    "skis", "snowboard", "sports ball", "kite", "baseball bat", "baseball glove", "skateboard", "surfboard",
    "tennis racket", "bottle", "wine glass", "cup", "fork", "knife", "spoon", "bowl", "banana", "apple",
    "sandwich", "orange", "broccoli", "carrot", "hot dog", "pizza", "donut", "cake", "chair", "couch",
    "potted plant", "bed", "dining table", "toilet", "tv", "laptop", "mouse", "remote", "keyboard", "cell phone",
    "microwave", "oven", "toaster", "sink", "refrigerator", "book", "clock", "vase", "scissors", "teddy bear",
    "hair drier", "toothbrush",
)


def synonym_map(vocabulary: list[str]) -> dict[str, str]:
    """Text to canonical label; of vocabulary entries that share a synonym the first wins."""
    out: dict[str, str] = {}
    for entry in vocabulary:
        name = entry.strip().lower()
        for text in SYNONYMS.get(name, (name,)) if name else ():
            out.setdefault(text, name)
    return out


def canonical_label(label: Column, vocabulary: list[str] | None) -> Column:
    """Trimmed lower-case label; with a vocabulary its canonical member, or "" when none matches (also for an empty one)."""
    text = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    if vocabulary is None:
        return text
    known = synonym_map(vocabulary)
    if not known:
        return F.lit("")
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(table, text), F.lit(""))


def class_index(label: Column, classes: tuple[str, ...] = CLASSES_80) -> Column:
    """Position in the class table; null when unknown."""
    return F.nullif(F.array_position(F.array(*[F.lit(c) for c in classes]), label), F.lit(0)) - 1


def class_table(spark, configured: list[str], space: str = "compact") -> DataFrame:
    """(label, class_id): compact 0..n-1, or the configured classes' places among the 80."""
    ids = {c: i for i, c in enumerate(CLASSES_80)}
    rows = list(enumerate(configured)) if space == "compact" else [(ids[c], c) for c in configured if c in ids]
    return spark.createDataFrame(rows, "class_id int, label string").select("label", "class_id")


def remap_classes(lines: DataFrame, names: DataFrame, classes: DataFrame) -> DataFrame:
    """Label lines into another class table by name; ids without a name there are dropped."""
    old = names.select(F.col("class_id").alias("_old"), F.col("label").alias("_name"))
    new = classes.select(F.col("label").alias("_name"), F.col("class_id").alias("_new"))
    mapped = old.join(F.broadcast(new), "_name").select("_old", "_new")  # class tables have at most a few thousand rows
    joined = lines.join(F.broadcast(mapped), F.col("class_id") == F.col("_old"))
    return joined.withColumn("class_id", F.col("_new")).drop("_old", "_new")


def vocabulary_of(objects: DataFrame, label: str, order: str) -> DataFrame:
    """(label, class_id) in order of first appearance."""
    first = objects.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.min(order).alias("_first"))
    placed = ranges.ranked(written(first), [], [F.asc("_first"), F.asc("label")], "_place")  # free text may have many labels
    return placed.select("label", (F.col("_place") - 1).cast("int").alias("class_id"))


def json_body(content: Column) -> Column:
    """The last fenced block of a response that is not blank, or all of it."""
    fence = F.regexp_extract_all(content, F.lit(r"(?s)```(?:json)?\s*(.*?)```"), F.lit(1))
    last = F.try_element_at(F.filter(fence, lambda x: F.length(F.trim(x)) > 0), F.lit(-1))
    return F.coalesce(F.when(F.contains(content, F.lit("```")), last), content)


def json_part(text: Column) -> Column:
    """From the first brace (else bracket) to the last."""

    def cut(opening: str, closing: str) -> Column:
        start = F.instr(text, opening)
        end = F.length(text) - F.length(F.substring_index(text, closing, -1))
        return F.when((start > 0) & F.contains(text, F.lit(closing)) & (end > start), F.substring(text, start, end - start + 1))

    brace, bracket = F.instr(text, "{"), F.instr(text, "[")
    listed = (bracket > 0) & ((brace == 0) | (bracket < brace))
    objects, lists = cut("{", "}"), cut("[", "]")
    return F.when(listed, F.coalesce(lists, objects)).otherwise(F.coalesce(objects, lists))


def json_text(content: Column) -> Column:
    """The JSON part of a response: the last fenced block or all, from the first brace (else bracket) to the last."""
    return let(json_body(content), json_part)


def tolerant_json(text: Column) -> Column:
    """VARIANT, or null for empty and bad text; an object or list must also end as one, since the parser lets text follow."""
    own = F.trim(text)
    ends = F.concat(F.substring(own, 1, 1), F.substring(own, -1, 1))
    return F.try_parse_json(F.when((F.length(own) > 0) & (ends.isin("{}", "[]") | ~F.substring(ends, 1, 1).isin("{", "[")), text))


def run_name(name: Column) -> Column:
    """struct(model, tag): split at the last hyphen; the tag is empty without one."""
    split = F.regexp_extract(name, r"^(.*)-([^-]*)$", 1)
    has = F.instr(name, "-") > 0
    return F.struct(F.when(has, split).otherwise(name).alias("model"), F.when(has, F.regexp_extract(name, r"^(.*)-([^-]*)$", 2)).otherwise("").alias("tag"))
