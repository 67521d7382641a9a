"""Places in a total order, found without one task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import checkpointed, small


def in_order(rows: DataFrame, order: list[Column | str], to: str) -> DataFrame:
    """`rows` with their place (from 0) in `order` in column `to`; ties are in any order.

    Rows go to ranges of the order and are sorted there; a row's place is its place in its range after all of the
    ranges before, whose sizes are the only thing that is put together. Ranges are written to the checkpoint folder, as
    their bounds are sampled: both reads must be of the same ranges, also where an executor is lost.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = checkpointed(ranged.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = checkpointed(ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    return ranged.join(small(starts), "_range").withColumn(to, F.col("_start") + F.col("_at")).drop("_range", "_at", "_start")
