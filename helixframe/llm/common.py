"""What the operators share: reading tables, checkpoints, distributed numbering, Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import checkpointed, shared_folder

__all__ = ["BROADCAST_BYTES", "buckets_for", "checkpointed", "free_name", "map_batches", "map_rows", "numbered", "shared_folder", "table", "text_or_empty"]

#: A frame is broadcast by hint only if its measured size is at most this; beyond it, joins shuffle.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, schema: str, start: Callable[[], Callable[[list[list]], list[list]]]) -> DataFrame:
    """Rows of `df`, batch by batch, through `start()(columns)`, which returns the columns of `schema`.

    `start` runs once a task, so what it builds (models, caches) is kept for the task's batches.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            if batch.num_rows:
                made = step([c.to_pylist() for c in batch.columns])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, out, strict=True)], schema=out)

    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """Rows of `df`, batch by batch, through `start()(batch)`, which returns a batch with the same columns; `start` runs once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return df.mapInArrow(run, df.schema)


def buckets_for(rows: int) -> int:
    """How many hash buckets a group of so many rows is numbered in: about 65,536 rows each, 1,024 to 1,048,576 buckets."""
    return max(1024, min(1 << 20, rows >> 16))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores behind it as make it no column of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, group: str, order: list[str], to: str, buckets: int = 1024) -> DataFrame:
    """`df` with a number in column `to`, gapless from 0 within each `group`, without one task per group.

    Rows of a group go to hash buckets of the order columns; rows are numbered within a bucket and each bucket starts
    where those before it end. The numbers follow (bucket, order); rows equal in `order` are numbered in any order.
    No group may be null. Rows equal in `order` are in one bucket, so `order` should tell most rows apart. The join needs no shuffle of its own, as the window's is by the same columns.
    """
    put = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = put.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col(group).alias("_g"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(group, "_bucket").orderBy(*order)
    rows = put.withColumn("_row", F.row_number().over(within) - 1)
    return (
        rows.join(starts, (rows[group] == F.col("_g")) & (rows["_bucket"] == F.col("_b")))
        .withColumn(to, F.col("_start") + F.col("_row"))
        .drop("_bucket", "_g", "_b", "_start", "_row")
    )


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
