"""Running totals that do not gather all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_total(
    rows: DataFrame, number: str, value: str, name: str, block: int = 4096
) -> DataFrame:
    """Running sum of ``value`` in the order of the integer column ``number``.

    Rows are summed inside blocks of ``number``; only one total per block goes
    through the window that spans all blocks.
    """
    blocked = rows.withColumn("block", F.floor(F.col(number) / block))
    inside = Window.partitionBy("block").orderBy(number).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy("block")
        .agg(F.sum(value).alias("total"))
        .select("block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    )
    return (
        blocked.withColumn("partial", F.sum(value).over(inside))
        .join(offsets, "block")
        .withColumn(name, F.col("partial") + F.col("offset"))
        .drop("block", "partial", "offset")
    )
