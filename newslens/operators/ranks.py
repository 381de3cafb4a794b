"""Row numbers over large groups, without a task for a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import stash


def numbered(rows: DataFrame, order: Sequence[Column], out: str, group: Sequence[str] = ()) -> DataFrame:
    """rows with ``out``: 1, 2, ... in the given order, over all of them or within each group.

    Rows are cut into as many ranges of group and order as Spark shuffles to,
    which are written so that they stay; rows are numbered within a range and
    shifted by the counts of the group's ranges before. A group with most of the
    rows is many ranges, and many small groups are one.
    """
    by, place = list(group), [*group, "_range"]
    ranged = stash(rows.repartitionByRange(*map(F.col, by), *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    # a row for each range, and for each group and range that meet
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*place, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*place).orderBy(*order))
    shifted = ranged.withColumn(out, within).alias("r").join(offsets.alias("o"), [F.col(f"r.{x}").eqNullSafe(F.col(f"o.{x}")) for x in place])
    return shifted.select(*[F.col(f"r.{x}") for x in rows.columns], (F.col(f"r.{out}") + F.col("o._before")).alias(out))
