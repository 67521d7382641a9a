"""Splice-junction tables: filter, merge, order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["chr", "start", "end", "strand"]


def long_enough(junctions: DataFrame, least: int = 50) -> DataFrame:
    """Rows with end - start of `least` or more; keys stay the text that they are."""
    return junctions.filter(F.col("end").cast("bigint") - F.col("start").cast("bigint") >= least)


def unannotated(junctions: DataFrame) -> DataFrame:
    return junctions.filter(F.col("annotated").cast("int") != 1)


def merge(junctions: DataFrame, order: list[str], least_length: int = 50, least_coverage: int = 5) -> DataFrame:
    """One row per key: sums of coverage and multimap, the largest overhang, the motif of the first row by `order`.

    Rows are filtered by length and annotation before, groups by coverage after. `first` is the least of `order`, by
    which the output can be put in order of first appearance. One hash aggregate with partial sums, one shuffle.
    """
    first = F.struct(*order)
    rows = unannotated(long_enough(junctions, least_length))
    merged = rows.groupBy(*KEY).agg(
        F.min_by("motif", first).alias("motif"), F.sum("coverage").alias("coverage"), F.sum("multimap").alias("multimap"), F.max("overhang").alias("overhang"), F.min(first).alias("first")
    )
    return merged.filter(F.col("coverage") >= least_coverage).withColumn("annotated", F.lit(1))
