"""Cutting lineage through the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where none is set, one process in local mode sets its own; a cluster must name one that all
    executors share."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="framelake-")
        context.setCheckpointDir(folder)
    return folder


def written(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder and reads it back: computed once, kept if executors are lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing will read again."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: A written table of up to this many rows may be broadcast; beyond it both sides of the join are shuffled.
BROADCAST_ROWS = 100_000


def join_counted(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Joins a table that is small by nature but comes from data: it is written and counted, and broadcast only if it is small."""
    right = written(right)
    return left.join(right.hint("broadcast" if right.count() <= BROADCAST_ROWS else "merge"), on, how)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, for work that is long for its bytes: a shuffle ahead of it where the input has fewer files than there are cores, else ``df`` itself."""
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df
