"""Junction tables that arrive as files: running sums by key, and the same result as a merge of all files so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.junctions import KEY, long_enough, unannotated
from .counters import counted

SCHEMA = "chr string, start string, end string, strand string, motif int, annotated int, coverage bigint, multimap bigint, overhang bigint, file_ord int, at bigint"


def read_stream(spark: SparkSession, folder: str, files: int = 1000) -> DataFrame:
    """Parquet files of junction rows (see SCHEMA), at most `files` a batch; each batch is counted as `junctions` (see counters)."""
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(folder)
    return counted(rows, "junctions", n_annotated=F.count_if(F.col("annotated") == 1), coverage=F.sum("coverage"))


def running_merge(rows: DataFrame, least_length: int = 50, least_coverage: int = 5) -> DataFrame:
    """As operators.junctions.merge, kept up to date; state is a row per key, and old keys stay, as there is no event time."""
    first = F.struct("file_ord", "at")
    merged = unannotated(long_enough(rows, least_length)).groupBy(*KEY).agg(
        F.min_by("motif", first).alias("motif"), F.sum("coverage").alias("coverage"), F.sum("multimap").alias("multimap"), F.max("overhang").alias("overhang"), F.min(first).alias("first")
    )
    return merged.filter(F.col("coverage") >= least_coverage).withColumn("annotated", F.lit(1))


def write_stream(merged: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """The whole result after each batch, as an in-memory table `name`."""
    return merged.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
