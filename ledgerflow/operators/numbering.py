"""Consecutive row numbers over a whole frame without sending it to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.sorting import POSITION, positioned
from ledgerflow.session import materialize

_WITHIN = (1 << 33) - 1


def number_rows(df: DataFrame, order: list[Column], name: str = "row_no") -> DataFrame:
    """Add 1, 2, 3 … in the given total order.

    Rows are range-sorted and written once with the partition they are in and their place in it, so the numbering does
    not depend on partitions being rebuilt alike. Counts per partition then give each partition its offset. The input
    position breaks ties, so equal keys may span ranges.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN))
    ordered = positioned(df).orderBy(*order, POSITION).drop(POSITION)
    placed = materialize(ordered.withColumns({"_part": F.spark_partition_id(), "_pos": place}), "numbered")
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # One row per partition of the sorted frame: the window and the broadcast are bounded by the partition count.
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(name, F.col("_offset") + F.col("_pos") + 1).drop("_part", "_pos", "_offset")
