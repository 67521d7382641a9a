"""Sharding by longest processing time: groups of equal texts, largest first, to the least-loaded shard."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, numbered, text_or_empty


def longest_first(sizes: dict[tuple, int], shards: int) -> dict[tuple, int]:
    """Items, largest first (ties by key), each to the least-loaded shard (ties: the lowest)."""
    heap, placed = [(0, s) for s in range(shards)], {}
    for key in sorted(sizes, key=lambda k: (-sizes[k], k)):
        load, shard = heapq.heappop(heap)
        placed[key] = shard
        heapq.heappush(heap, (load + sizes[key], shard))
    return placed


def assign_shards(docs: DataFrame, shards: int = 16, bins: int = 16_384, heavy_parts: int = 64, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, size, text_crc32, law, shard, slot, grown_shard for every row.

    Equal texts (null counts as empty) have one hash and stay together. A group over 1/(shards * heavy_parts) of all
    bytes is an item of its own, and so at most shards * heavy_parts groups are; smaller groups are bundled by hash into
    `bins` items. The heap therefore gets at most shards * heavy_parts + bins items whatever the input, and its answer
    is a table of that size, which is what is broadcast. A group over 1/shards of all bytes makes its shard larger.
    Ties between loads go to the lowest shard, between sizes to the lesser item. Very long texts count whole. Rows with a
    null key or repeated rows are rows like any other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    whole = text_or_empty(text)
    rows = docs.select(F.col(key), (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"), F.xxhash64(whole).alias("_group"))
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_size"))
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    least = total / (shards * heavy_parts)
    # heavy groups are told by -1, other groups by their bin
    item = F.when(F.col("_size") > least, F.struct(F.lit(-1).alias("bin"), F.col("_group").alias("hash"))).otherwise(
        F.struct(F.pmod("_group", F.lit(bins)).cast("int").alias("bin"), F.lit(0).cast("long").alias("hash"))
    )
    sizes = {(r.bin, r.hash): r.n for r in groups.groupBy(item.alias("i")).agg(F.sum("_size").alias("n")).select("i.bin", "i.hash", "n").collect()}
    placed = longest_first(sizes, shards)
    heavy = spark.createDataFrame([(h, s) for (b, h), s in placed.items() if b < 0], "_heavy long, _heavy_shard int")
    light = spark.createDataFrame([(b, s) for (b, _), s in placed.items() if b >= 0], "_bin int, _bin_shard int")
    out = (
        rows.join(F.broadcast(heavy), F.col("_group") == F.col("_heavy"), "left")
        .join(F.broadcast(light), F.pmod("_group", F.lit(bins)).cast("int") == F.col("_bin"), "left")
        .select(key, "size", "text_crc32", F.coalesce("_heavy_shard", "_bin_shard").alias("shard"))
    )
    return numbered(out, "shard", [key, "text_crc32"], "slot", buckets_for(n // shards)).select(
        key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
