"""The corpus pipeline: language, near copies, benchmark leaks, mix, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again before the
next one. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framelake.llm import decontaminate, io, langid, mixing, sharding, simhash


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages go on; those without letters (null and empty texts too) or with an unsure prediction do
    not. Each row is judged by its own text: rows without an id, or under one, and repeated rows do not matter. Empty in, empty out."""
    return langid.in_known_language(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of copies (five-word shingles, similarity 0.8 or more) goes on: that of smallest doc_id, one
    without an id only if the group has no other. Texts without a word are copies of each other; of equal rows one goes on."""
    return simhash.one_of_each_group(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item go on, each judged by its own text; null and empty texts hold none."""
    return decontaminate.without_benchmark(docs, io.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go on as often as the mix takes them: not at all, once or twice; those without words once. A null source is a source of
    its own; rows equal in doc_id, source and size share one decision."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and its place there; rows without an id, and repeated ones, are placed one by one."""
    return sharding.by_rows(docs)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing to target weights", mix),
    ("sharding", shards),
]
#: Trained and iterative stages: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other over ``documents``; a stage's table goes when the next one's is there."""
    docs, last = io.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = io.stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
        if last is not None:
            io.discard(last)
        last = docs
    return docs
