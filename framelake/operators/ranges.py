"""Places of rows within groups by equi-depth ranges of the whole sort key, so that no group and no value is one task's work."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import written


def cut(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """``df`` with ``_part``, the number of its range in the order of (group, order), as a written table. Ranges come from quantiles, so a hot group
    has many; only rows that are equal in the whole key share one in any case."""
    return written(df.repartitionByRange(*[F.col(c).asc() for c in group], *order).withColumn("_part", F.spark_partition_id()))


def before(table: DataFrame, group: list[str], **sums: Column) -> DataFrame:
    """(group, _part) with the sums over the group's earlier ranges, and ``<name>_all`` over the whole group."""
    parts = table.groupBy(*group, "_part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    return parts.select(*group, "_part", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in sums], *[F.sum(n).over(whole).alias(f"{n}_all") for n in sums])


def with_before(table: DataFrame, group: list[str], **sums: Column) -> DataFrame:
    """``table`` with the columns of ``before``; null groups are groups."""
    found = before(table, group, **sums).toDF(*[f"_g{i}" for i in range(len(group))], "_p", *sums, *[f"{n}_all" for n in sums])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)], F.col("_part") == F.col("_p"))
    return table.join(found.hint("merge"), same).drop("_p", *[f"_g{i}" for i in range(len(group))])


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: the row's place within its group, from 1. ``order`` should be unique: ties go either way."""
    placed = cut(df, group, order)
    own = placed.withColumn("_place", F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order)))
    return with_before(own, group, _b=F.lit(1)).select(*df.columns, (F.col("_place") + F.col("_b")).alias(name))


def changed(table, names: list[str], before: list | None = None):
    """Whether each row of an Arrow table or batch that is not empty differs from the row before it in these columns, the first one from the values ``before``; nulls are equal."""
    import numpy as np
    import pyarrow.compute as pc

    out = np.zeros(table.num_rows, bool)
    out[0] = before is None or before != [table.column(c)[0].as_py() for c in names]
    for c in names:
        column = table.column(c)
        here, above = column.slice(1), column.slice(0, len(column) - 1)
        same = pc.or_(pc.fill_null(pc.equal(here, above), False), pc.and_(pc.is_null(here), pc.is_null(above)))
        out[1:] |= ~np.asarray(same)
    return out
