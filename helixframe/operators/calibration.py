"""Scored splice sites against an annotated background: bins, null profiles, derived scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import checkpointed, small

# Lower edges of the 14 bins, and the upper end of the last, which is closed.
EDGES = (0.0, 0.001, 0.01, 0.1, 0.2, 0.4, 0.6, 0.8, 0.9, 0.95, 0.97, 0.99, 0.995, 0.999, 1.0)
LEAST_SCORE = 0.001
FLOOR, CEILING = -4, 13


def scored(sites: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """Sites with a score, not NaN, of `least` or more, compared as floats."""
    return sites.filter(~F.isnan("score") & (F.col("score") >= F.lit(least).cast("float")))


def score_bin(score: Column) -> Column:
    """0 to 13: the bin of a float score after clamping to [0, 1]; NaN is in the last."""
    last = len(EDGES) - 2
    found = F.when(F.isnan(score), last)
    for k in range(last):
        found = found.when(score < F.lit(EDGES[k + 1]).cast("float"), k)
    return found.otherwise(last)


def distinct_motifs(sites: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """`by`, motif and n: of sites distinct by `by`, chrom, pos and strand (the least motif, if a site has several)."""
    return sites.groupBy(*by, "chrom", "pos", "strand").agg(F.min("motif").alias("motif")).groupBy(*by, "motif").agg(F.count(F.lit(1)).alias("n"))


def null_profile(genome_counts: DataFrame, annotated_counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """`by`, motif and p_null: annotated over genome counts, 0 where the genome has none. Both inputs are `by`, motif, n."""
    g, a = genome_counts.withColumnRenamed("n", "_g"), annotated_counts.withColumnRenamed("n", "_a")
    both = g.join(a, [*by, "motif"], "full_outer")
    return both.select(*by, "motif", F.when(F.col("_g") > 0, F.coalesce(F.col("_a"), F.lit(0)) / F.col("_g")).otherwise(F.lit(0.0)).alias("p_null"))


def flagged(sites: DataFrame, annotated: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """`sites` with `annotated`: whether `by`, chrom, pos and strand are among those of `annotated`."""
    key = [*by, "chrom", "pos", "strand"]
    keys = annotated.select(*key).distinct().withColumn("_hit", F.lit(True))
    return sites.join(keys, key, "left").withColumn("annotated", F.col("_hit").isNotNull()).drop("_hit")


def bins(flagged_sites: DataFrame, genome_counts: DataFrame, annotated_counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """`by`, motif, bin, n_total, n_real and p for every motif (of the genome, the annotation or the scores) and all 14 bins.

    What the genome has more than was scored is added to bin 0, and of that at most what the annotation has more than
    was found. Motifs are few, so that all after the first aggregate is small. Both counts are `by`, motif, n.
    """
    n_bins, key = len(EDGES) - 1, [*by, "motif"]
    counted = flagged_sites.groupBy(*key, score_bin(F.col("score")).alias("bin")).agg(F.count(F.lit(1)).alias("n_total"), F.count_if("annotated").alias("n_real"))
    motifs = counted.select(*key).unionByName(genome_counts.select(*key)).unionByName(annotated_counts.select(*key)).distinct()
    grid = motifs.select(*key, F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    known = genome_counts.withColumnRenamed("n", "_genome").join(annotated_counts.withColumnRenamed("n", "_annotated"), key, "full_outer")
    full = grid.join(counted, [*key, "bin"], "left").join(known, key, "left").na.fill(0, ["n_total", "n_real", "_genome", "_annotated"])
    every = Window.partitionBy(*key)
    unscored = F.greatest(F.lit(0), F.col("_genome") - F.sum("n_total").over(every))
    unfound = F.least(F.greatest(F.lit(0), F.col("_annotated") - F.sum("n_real").over(every)), unscored)
    full = full.withColumn("_t", F.when(F.col("bin") == 0, unscored).otherwise(0)).withColumn("_r", F.when(F.col("bin") == 0, unfound).otherwise(0))
    full = full.select(*key, "bin", (F.col("n_total") + F.col("_t")).alias("n_total"), (F.col("n_real") + F.col("_r")).alias("n_real"))
    return full.withColumn("p", F.when(F.col("n_total") > 0, F.col("n_real") / F.col("n_total")).otherwise(F.lit(0.0)))


def united(*parts: DataFrame) -> DataFrame:
    """The distinct rows of several tables, such as sites of both strands."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.distinct()


def by_site(genome_counts: DataFrame) -> DataFrame:
    """Genome counts for donors and for acceptors."""
    return genome_counts.select(F.explode(F.array(F.lit("D"), F.lit("A"))).alias("site"), "motif", "n")


def derived_score(p: Column, q: Column, floor: int = FLOOR, ceiling: int = CEILING) -> Column:
    """Twice the log2 of p over q, rounded half away from zero, within [floor, ceiling]; p = 0 gives floor, else q = 0 ceiling."""
    if floor > ceiling:
        raise ValueError("floor is over ceiling")
    raw = F.round(2 * F.log2(p / q))
    return F.when(p <= 0, floor).when(q <= 0, ceiling).otherwise(F.greatest(F.lit(floor), F.least(F.lit(ceiling), raw.cast("int"))))


def shifted(pos: Column, strand: Column, site: Column) -> Column:
    """Plus acceptors and minus donors are written one further on."""
    return pos + F.when(((site == "A") & (strand == "+")) | ((site == "D") & (strand == "-")), 1).otherwise(0)


def derive(sites: DataFrame, bins_by_motif: DataFrame, null: DataFrame, floor: int = FLOOR, ceiling: int = CEILING, by: tuple[str, ...] = ()) -> DataFrame:
    """chrom, coordinate, strand, site, motif and derived_score of scored sites (of one kind, unless `by` is site).

    Bins and null profile have a row for each motif and bin, or motif; they are written once, and broadcast if they are
    small, as they are where motifs are pairs of letters. What a motif lacks counts as 0.
    """
    key = [*by, "motif"]
    rates = small(checkpointed(bins_by_motif.select(*key, "bin", "p").join(null.select(*key, "p_null"), key, "full_outer")))
    joined = sites.withColumn("bin", score_bin(F.col("score"))).join(rates, [*key, "bin"], "left")
    score = derived_score(F.coalesce("p", F.lit(0.0)), F.coalesce("p_null", F.lit(0.0)), floor, ceiling)
    return joined.select("chrom", shifted(F.col("pos"), F.col("strand"), F.col("site")).alias("coordinate"), "strand", "site", "motif", score.cast("int").alias("derived_score"))


def derive_all(sites: DataFrame, annotated: DataFrame, genome_counts: DataFrame, floor: int = FLOOR, ceiling: int = CEILING) -> DataFrame:
    """Derived scores of donors and acceptors together. sites and annotated: chrom, pos, strand, site, motif (and score).

    Both kinds go through one pass, by site. Counts of the genome and of the annotation are small; they are written once.
    """
    site, own = ("site",), scored(sites).filter(F.col("site").isin("D", "A"))
    known = annotated.filter(F.col("site").isin("D", "A"))
    genome, counts = checkpointed(by_site(genome_counts)), checkpointed(distinct_motifs(known, site))
    return derive(own, bins(flagged(own, known, site), genome, counts, site), null_profile(genome, counts, site), floor, ceiling, site)


def output_order() -> list[Column]:
    """Chrom, coordinate, plus before minus, motif, donors before acceptors."""
    return [F.col("chrom"), F.col("coordinate"), (F.col("strand") != "+").cast("int"), F.col("motif"), (F.col("site") != "D").cast("int")]
