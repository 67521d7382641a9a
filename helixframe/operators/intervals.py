"""Intervals by chrom and strand: expand, dedupe, merge, split, introns, untranslated parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A last window shorter than this joins the one before.
LEAST_TAIL = 10


def expand(rows: DataFrame, upstream: int, downstream: int) -> DataFrame:
    """start - upstream (0 at least) and end + downstream, whatever the strand, each interval once."""
    wider = rows.withColumn("start", F.greatest(F.lit(0), F.col("start") - upstream)).withColumn("end", F.col("end") + downstream)
    return wider.dropDuplicates(["chrom", "strand", "start", "end"])


def _islands(rows: DataFrame, by: list[str], touch: bool) -> DataFrame:
    """Union of the overlapping intervals in each group of `by`."""
    along = Window.partitionBy(*by).orderBy("start", "end")
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    apart = reach.isNull() | ((F.col("start") > reach) if touch else (F.col("start") >= reach))
    marked = rows.withColumn("_new", apart.cast("int")).withColumn("_island", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*by, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def merge(rows: DataFrame, by: tuple[str, ...] = ("chrom", "strand"), touch: bool = False, bin_width: int = 1 << 20) -> DataFrame:
    """Bounds of each set of intervals that overlap, by `by`; with `touch`, those that only meet are merged too.

    Intervals are merged within bins of their start, many tasks to a chrom. What passes from bin to bin is how far the
    bins before reach, and where the last union that they begin starts: one row a bin, and the only thing that is put in
    order along a whole chrom. A bin's unions that begin before that reach belong to that last union. Of intervals with one
    start only the longest is dealt to its bin, so that a bin has at most as many rows as starts, however high they pile up.
    """
    rows = rows.groupBy(*by, "start").agg(F.max("end").alias("end")).withColumn("_bin", F.floor(F.col("start") / bin_width))
    unions = _islands(rows, [*by, "_bin"], touch)
    apart = lambda start: F.col("_reach").isNull() | ((start > F.col("_reach")) if touch else (start >= F.col("_reach")))
    before = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = unions.groupBy(*by, "_bin").agg(F.max("start").alias("_last"), F.max("end").alias("_to")).withColumn("_reach", F.max("_to").over(before))
    ends = ends.withColumn("_open", F.max(F.when(apart(F.col("_last")), F.col("_last"))).over(before)).select(*by, "_bin", "_reach", "_open")
    whole = unions.join(ends, [*by, "_bin"]).withColumn("start", F.when(apart(F.col("start")), F.col("start")).otherwise(F.col("_open")))
    return whole.groupBy(*by, "start").agg(F.max("end").alias("end"))


def windows(start: Column, end: Column, most: int, least_tail: int = LEAST_TAIL) -> Column:
    """Array of (start, end) of consecutive windows of `most`; a tail under `least_tail` joins the window before."""
    if most <= 0:
        raise ValueError("windows must be longer than 0")
    length = end - start
    tail = (length - 1) % most + 1
    full = F.floor((length - tail) / most)
    n = full + F.when((tail < least_tail) & (full > 0), 0).otherwise(1)
    one = lambda i: F.struct((start + i * most).alias("start"), F.when(i == n - 1, end).otherwise(start + (i + 1) * most).alias("end"))
    return F.when(length > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), one)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))


def split(rows: DataFrame, most: int = 500) -> DataFrame:
    """Each interval as windows of at most `most` (but for a joined tail), other columns as they are."""
    others = [c for c in rows.columns if c not in ("start", "end")]
    cut = rows.select(*others, F.explode(windows(F.col("start").cast("bigint"), F.col("end").cast("bigint"), most)).alias("_w"))
    return cut.select(*others, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"))


def bucket_order(rows: DataFrame) -> list[Column]:
    """Order by the text `chrom:strand`, then bounds: chr10:+ comes before chr1:+."""
    return [F.concat_ws(":", "chrom", "strand"), F.col("start"), F.col("end")]


def introns(exons: Column) -> Column:
    """Gaps between consecutive exons of an array of (start, end) structs."""
    n = F.size(exons)
    gap = lambda i: F.struct(F.get(exons, i - 1)["end"].alias("start"), F.get(exons, i)["start"].alias("end"))
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), gap)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))


def three_prime_parts(exons: Column, strand: Column, thick_start: Column, thick_end: Column) -> Column:
    """Parts of exons behind the coding part: after thick_end on the plus strand, before thick_start on the minus strand."""
    part = lambda e: F.when(strand == "-", F.struct(e["start"].alias("start"), F.least(e["end"], thick_start).alias("end"))).otherwise(F.struct(F.greatest(e["start"], thick_end).alias("start"), e["end"].alias("end")))
    return F.filter(F.transform(exons, part), lambda p: p["end"] > p["start"])
