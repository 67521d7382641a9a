"""Per-base tracks: windows over sequences, overlap-add of predictions, smoothing, thresholds, coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A window's length and stride, and the weights of a symmetric smoothing over 13 positions.
WINDOW, STRIDE = 205, 10
KERNEL = (0.005, 0.01, 0.025, 0.05, 0.085, 0.175, 0.3, 0.175, 0.085, 0.05, 0.025, 0.01, 0.005)


def sliding_windows(seqs: DataFrame, length: int = WINDOW, stride: int = STRIDE, pad: str = "X") -> DataFrame:
    """Each row's windows in place of seq: `window_start` and `window`, the last one padded on the right; one where seq is no longer than a window, none where it is empty.

    A sequence is cut in one pass into pieces of a number of strides, each with what its windows reach of the next; windows
    are counted from the start of their piece, so that time grows with the length and not with its square.
    """
    piece = stride * max(64, -(-length // stride))
    n, start = F.length("seq"), F.col("_piece") * piece
    cut = seqs.withColumn("_n", n.cast("bigint")).withColumn("_cut", F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))).filter(n > 0).drop("seq")
    others = [F.col(f"`{c}`") for c in seqs.columns if c.lower() != "seq"]
    more = lambda i: F.concat(F.get("_cut", i), F.substring(F.coalesce(F.get("_cut", i + 1), F.lit("")), 1, length - 1))
    pieces = cut.select(*others, "_n", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("_cut") - 1), more)).alias("_piece", "_seq"))
    last = F.when(F.col("_n") <= length, 0).otherwise(F.ceil((F.col("_n") - length) / stride) * stride)
    inner = F.least(last - start, F.lit(piece - stride)).cast("int")  # the last one that begins in the piece
    # dealt to all tasks before there are many windows of each
    rows = pieces.filter(inner >= 0).repartition(*others, "_piece").withColumn("_at", F.explode(F.sequence(F.lit(0), inner, F.lit(stride))))
    return rows.select(*others, (start + F.col("_at")).cast("int").alias("window_start"), F.rpad(F.substring("_seq", F.col("_at") + 1, F.lit(length)), length, pad).alias("window"))


def overlap_add(values: DataFrame, key: str = "seq_id", pos: str = "pos", value: str = "value") -> DataFrame:
    """Per position of each sequence: total of the windows' values, how many cover it, and their mean."""
    summed = values.groupBy(key, pos).agg(F.sum(value).alias("total"), F.sum(F.col(value) * F.col(value)).alias("squares"), F.count(value).alias("coverage"))
    return summed.withColumn("mean", F.col("total") / F.col("coverage"))


def spread(n_windows: Column) -> Column:
    """The deviation of an overlap-add: windows that don't cover a position count with the squared mean."""
    squared = F.col("squares") - 2 * F.col("mean") * F.col("total") + n_windows * F.col("mean") * F.col("mean")
    return F.sqrt(F.greatest(F.lit(0.0), squared) / F.col("coverage"))


def smoothed(rows: DataFrame, column: str, to: str, key: str = "seq_id", pos: str = "pos", kernel: tuple[float, ...] = KERNEL, tile: int = 1 << 16) -> DataFrame:
    """`rows` with the weighted sum of `column` over neighbours by position in `to`; positions beyond the ends, or that are missing, count as 0.

    A sequence is done in tiles of positions; rows near an edge are copied to the tile beyond it, and their copies dropped.
    """
    half = len(kernel) // 2
    at, within = F.floor(F.col(pos) / tile), F.pmod(F.col(pos), F.lit(tile))
    tiles = F.filter(F.array(at, F.when(within < half, at - 1), F.when(within >= tile - half, at + 1)), lambda t: t.isNotNull())
    dealt = rows.withColumn("_home", at).withColumn("_tile", F.explode(tiles))
    # by range, so that a missing position isn't taken for its neighbour
    near = lambda d: F.sum(column).over(Window.partitionBy(key, "_tile").orderBy(pos).rangeBetween(d, d))
    out = F.lit(0.0)
    for d, w in enumerate(kernel):
        out = out + F.coalesce(near(d - half), F.lit(0.0)) * w
    return dealt.withColumn(to, out).filter(F.col("_home") == F.col("_tile")).drop("_home", "_tile")


def ensemble_mean(predictions: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Mean of several models' values per position."""
    return predictions.groupBy(*by).agg(F.avg(value).alias("mean"))


def argmax(profile: DataFrame, key: str = "seq_id", pos: str = "pos", value: str = "value") -> DataFrame:
    """The first position of each sequence's largest value."""
    return profile.groupBy(key).agg(F.max_by(pos, F.struct(F.col(value), -F.col(pos))).alias("peak"), F.max(value).alias("height"))


def floored(p: Column, least: float, digits: int) -> Column:
    """p rounded to `digits`, ties to even, or 0 where it is under `least`."""
    return F.when(p >= F.lit(least), F.bround(p.cast("double"), digits)).otherwise(F.lit(0.0))


def flanks(start: Column, end: Column, length: Column, flank: int) -> Column:
    """Struct of the flanks before and after that a chunk's sequence of `length` has; an error where they don't fit."""
    before = F.least(F.lit(flank).cast("bigint"), start)
    after = length - (end - start) - before
    checked = F.when((after < 0) | (after > flank) | (end <= start), F.raise_error(F.lit("the sequence doesn't fit its header"))).otherwise(after)
    return F.struct(before.alias("before"), checked.alias("after"))


def core(values: Column, before: Column, after: Column, strand: Column) -> Column:
    """What a chunk's values have between its flanks; on the minus strand flanks change places and the core is reversed."""
    n = (F.size(values) - before - after).cast("int")
    plus, minus = F.slice(values, (before + 1).cast("int"), n), F.reverse(F.slice(values, (after + 1).cast("int"), n))
    return F.when(strand == "-", minus).otherwise(plus)


def profile_lines(profiles: DataFrame, least: float = 0.01) -> DataFrame:
    """chrom, line_start, line_end, value, name and strand of each profile value of `least` or more.

    profiles: chrom, start, end, strand, profile (array of doubles). Plus lines begin one before their base; minus
    profiles are reversed and end with the interval. Names count from 0 along the emitted direction.
    """
    rows = profiles.withColumn("_n", F.size("profile")).withColumn("_p", F.when(F.col("strand") == "-", F.reverse("profile")).otherwise(F.col("profile")))
    flat = rows.select("chrom", "start", "end", "strand", "_n", F.posexplode("_p").alias("_i", "value")).filter(F.col("value") >= least)
    line = F.when(F.col("strand") == "-", F.col("end") - F.col("_n") + F.col("_i")).otherwise(F.col("start") + F.col("_i") - 1)
    return flat.select("chrom", line.alias("line_start"), (line + 1).alias("line_end"), "value", F.concat(F.lit("peak_"), F.col("_i").cast("string")).alias("name"), "strand")
