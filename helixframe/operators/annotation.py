"""Splice sites of transcripts (see sources.text.read_bed12 for their columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import reverse_complement, site_start
from .calibration import scored
from .genome import cut, known_only
from .intervals import introns


def splice_sites(transcripts: DataFrame, genome: DataFrame) -> DataFrame:
    """chrom, pos, strand, site and motif of both ends of every intron; sites whose motif isn't whole are left out.

    An intron [a, b) has its left motif at [a, a + 2) and its right one at [b - 2, b). Plus donors are keyed a and
    acceptors b - 1; minus donors b and acceptors a, with reverse complemented motifs. A strand that is neither is
    taken as plus and keeps its own sign, so that it matches no scored site; a null strand is an error. Each intron
    meets the piece of the genome that it needs.
    """
    strand = F.when(F.col("strand").isNull(), F.raise_error(F.lit("a transcript without strand")).cast("string")).otherwise(F.col("strand"))
    gaps = transcripts.select("chrom", strand.alias("strand"), F.explode(introns(F.col("exons"))).alias("i")).select("chrom", "strand", "i.start", "i.end").distinct()
    a, b, minus = F.col("start"), F.col("end"), F.col("strand") == "-"
    site = lambda kind, pos, at: F.struct(F.lit(kind).alias("site"), pos.cast("bigint").alias("pos"), at.cast("bigint").alias("a"))
    both = F.when(minus, F.array(site("D", b, b - 2), site("A", a, a))).otherwise(F.array(site("D", a, a), site("A", b - 1, b - 2)))
    at = gaps.select("chrom", "strand", F.explode(both).alias("s")).select("chrom", "strand", "s.site", "s.pos", F.col("s.a").alias("_a"), (F.col("s.a") + 2).alias("_b"))
    rows = cut(at, genome, "_a", "_b", "_pair", reach=2)
    motif = F.when(minus, reverse_complement(F.col("_pair"))).otherwise(F.upper("_pair"))
    return rows.select("chrom", "pos", "strand", "site", motif.alias("motif")).filter(F.col("motif").isNotNull())


def scored_sites(tracks: DataFrame, genome: DataFrame, least: float = 0.001) -> DataFrame:
    """chrom, pos, strand, site, score and motif of track values (chrom, pos, score, strand, site) of `least` or more.

    Contigs that the genome lacks, and sites whose motif isn't whole, are left out.
    """
    start = site_start(F.col("pos"), F.col("strand"), F.col("site"))
    rows = known_only(scored(tracks, least), genome).withColumn("_a", start).withColumn("_b", start + 2)
    pair = F.col("_pair")
    motif = F.when(F.col("strand") == "-", reverse_complement(pair)).otherwise(F.upper(pair))
    return cut(rows, genome, "_a", "_b", "_pair", reach=2).select("chrom", "pos", "strand", "site", "score", motif.alias("motif")).filter(F.col("motif").isNotNull())
