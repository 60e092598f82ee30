"""Running totals over a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def running_total(df: DataFrame, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Add ``name``: sum of ``value`` over all rows up to the current one in ``order``.

    The order must be total. Rows are cut into balanced ranges of the order and staged with
    their range number; the sums of the ranges before give each range its offset. The offsets
    are one row per range (at most the number of shuffle partitions), hence the broadcast.
    """
    ranged = stage(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum(value).alias("_sum"))
        .select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    )
    within = (
        Window.partitionBy("_range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum(value).over(within), F.lit(0)))
        .drop("_range", "_offset")
    )
