"""Reading tables and cutting lineage through the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Stands for a null id while rows are in Python, where nulls would turn whole columns into floats.
NO_ID = -(1 << 62)


def with_ids(df: DataFrame, name: str, *columns) -> DataFrame:
    """The id column without nulls, and the given columns; all others stay behind."""
    return df.select(F.coalesce(df[name].cast("long"), F.lit(NO_ID)).alias(name), *columns)


def null_ids(df: DataFrame, name: str) -> DataFrame:
    """Puts back the nulls of ``with_ids``."""
    return df.withColumn(name, F.when(F.col(name) != NO_ID, F.col(name)))


def keep_rows(df: DataFrame, column: str, test: Callable[[list], object]) -> DataFrame:
    """Rows whose value in ``column`` passes ``test`` (values to booleans), as they stand: judged in Arrow batches where they are read, without a shuffle."""
    place = df.columns.index(column)

    def rows(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(test(batch.column(place).to_pylist()), pa.bool_()))

    return df.mapInArrow(rows, df.schema)


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share. Where it is unset, one process in local mode (as in tests)
    sets its own; a cluster must name it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="framelake-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: computed once, kept if executors are lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a stored table that nothing will read again."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_bytes(df: DataFrame) -> int:
    """Size on disk of a stored table."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


#: A stored table up to this size may be broadcast; beyond it the join shuffles both sides.
BROADCAST_BYTES = 16 << 20


def size_hint(df: DataFrame, limit: int = BROADCAST_BYTES) -> str:
    """Join strategy for a stored table, by its measured size."""
    return "broadcast" if stored_bytes(df) <= limit else "merge"


def join_small(left: DataFrame, right: DataFrame, on, how: str) -> DataFrame:
    """Joins a stored table: broadcast if its measured size allows, else a sort-merge join."""
    return left.join(right.hint(size_hint(right)), on, how)
