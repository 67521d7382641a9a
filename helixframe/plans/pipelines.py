"""The entry points: from files to files, with the parameters of the command lines as arguments."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence
from ..operators import alignment, annotation, calibration, chains, genome, intervals, junctions, scoring, tracks
from ..sources import binary, paths, sinks, text


def join_junctions(spark: SparkSession, files: list[str], out: str, least_length: int = 50, least_coverage: int = 5) -> DataFrame:
    """Merged junctions; ALL_SJ_out_filtered.tab in `out` is a folder of their lines, in order of first appearance."""
    paths.check_number("least_length", least_length)
    merged = junctions.merge(text.read_junctions(spark, files), ["file_ord", "at"], least_length, least_coverage)
    sinks.junction_lines(merged).write.mode("overwrite").text(f"{out}/ALL_SJ_out_filtered.tab")
    return merged


def chunk_genome(spark: SparkSession, path: str, out: str, chunk: int = 6_000_000, flank: int = 50_000, least: int = 500, gz: bool = False, revcomp_minus: bool = False) -> list[str]:
    """FASTA files of chunks with both strands, in `out`/chunks; their names."""
    paths.check_number("chunk", chunk, strictly=True)
    paths.check_number("flank", flank)
    made = genome.both_strands(genome.tiles(paths.read_genome(spark, path), chunk, flank, least), revcomp_minus)
    return sinks.write_chunk_fasta(made, f"{out}/chunks", gz)


def checked_chunks(records: DataFrame, flank: int) -> DataFrame:
    """chrom, start, end, strand, seq (upper case), before and after of FASTA records of chunks; an error where a header or a length doesn't fit."""
    head = sequence.parsed_region_header(F.col("chrom"))
    bad = head["start"].isNull() | (F.length("seq") == 0)
    start = F.when(bad, F.raise_error(F.concat(F.lit("not a chunk: "), F.col("chrom"))).cast("bigint")).otherwise(head["start"])
    chunks = records.select(head["chrom"].alias("chrom"), start.alias("start"), head["end"].alias("end"), head["strand"].alias("strand"), F.upper("seq").alias("seq"))
    return chunks.withColumn("f", tracks.flanks(F.col("start"), F.col("end"), F.length("seq").cast("bigint"), flank)).select("*", "f.before", "f.after").drop("f")


def predict_sites(spark: SparkSession, path: str, scorer: Callable, out: str, flank: int = 50_000, least: float = 0.001, digits: int = 4, context: int = scoring.CONTEXT) -> list[str]:
    """Four fixed-step files of the scores of a chunk file's records, without flanks; their names."""
    paths.check_number("least", least, most=1)
    chunks = checked_chunks(text.read_fasta(spark, path, mode="predict"), flank)
    scored = scoring.score_sites(chunks, scorer, context, keep=("before", "after"))
    cut = lambda c: tracks.core(F.col(c), F.col("before"), F.col("after"), F.col("strand")).alias(c)
    return sinks.write_wig(scored.select("chrom", "start", "strand", cut("acceptor"), cut("donor")), out, paths.output_stem(path), least, digits)


def derive_scores(spark: SparkSession, folder: str, sequence_path: str, regions: str, out: str, prefix: str = "spliceai", floor: int = calibration.FLOOR, ceiling: int = calibration.CEILING) -> DataFrame:
    """Derived scores of the four tracks in `folder`; <prefix>.derived.tsv in `out` is a folder of their lines, in order."""
    if floor > ceiling:
        raise ValueError("floor is over ceiling")
    whole = paths.read_genome(spark, sequence_path, mode="strict")
    values = None
    for (site, strand), path in paths.discover_tracks(folder).items():
        one = binary.read_bigwig(spark, path, least=calibration.LEAST_SCORE).select("chrom", "pos", "score", F.lit("+" if strand == "plus" else "-").alias("strand"), F.lit("D" if site == "donor" else "A").alias("site"))
        values = one if values is None else values.unionAll(one)
    known = annotation.splice_sites(text.read_transcripts(spark, regions), whole)
    derived = calibration.derive_all(annotation.scored_sites(values, whole), known, genome.pair_counts(whole), floor, ceiling)
    sinks.derived_lines(derived).write.mode("overwrite").text(f"{out}/{prefix}.derived.tsv")
    return derived


def utr_windows(transcripts: DataFrame, whole: DataFrame, upstream: int = 100, downstream: int = 100, most: int = 500, clip: bool = False) -> DataFrame:
    """chrom, start, end, strand and seq of windows over the merged, expanded untranslated ends of transcripts."""
    paths.check_number("most", most, strictly=True)
    parts = intervals.three_prime_parts(F.col("exons"), F.col("strand"), F.col("thick_start"), F.col("thick_end"))
    utr = transcripts.select("chrom", "strand", F.explode(parts).alias("p")).select("chrom", "strand", "p.start", "p.end")
    windows = intervals.split(intervals.merge(intervals.expand(utr, upstream, downstream)), most)
    if clip:  # to the contig; what begins past its end goes
        sizes = genome.sizes(whole).withColumnRenamed("chrom", "_chrom")
        windows = windows.join(sizes, F.col("chrom") == F.col("_chrom")).withColumn("end", F.least("end", "size")).filter("start < `end`").drop("_chrom", "size")
    rows = genome.cut(windows, whole, reach=most + intervals.LEAST_TAIL)
    seq = F.when(F.col("seq").isNull(), F.raise_error(F.lit("a window ends past its sequence")).cast("string")).when(F.col("strand") == "-", sequence.strict_reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    return rows.select("chrom", "start", "end", "strand", seq.alias("seq"))


def chunk_utrs(spark: SparkSession, bed: str, sequence_path: str, out: str, upstream: int = 100, downstream: int = 100, most: int = 500, rows_per_file: int | None = None, prefix: str = "part", gz: bool = False) -> list[str]:
    """Tab-separated files of utr_windows, in bucket order: several of rows_per_file rows in a `chunks` folder, or one; their names."""
    made = utr_windows(text.read_bed12(spark, bed), paths.read_genome(spark, sequence_path), upstream, downstream, most)
    columns, order = ["chrom", "start", "end", "strand", "seq"], intervals.bucket_order(made)
    if rows_per_file:
        return sinks.write_rotating(made, paths.chunk_folder(out), prefix, columns, order, rows_per_file, gz)
    name = paths.single_file(out, gz)
    sinks.write_tsv(made, name, columns, order)
    return [name]


def polya_profiles(windows: DataFrame, scorer: Callable, smooth: bool = True, upper: bool = False) -> DataFrame:
    """chrom, start, end, strand and profile (array) of rows with those and seq: a model's cuts, smoothed and averaged over the windows."""
    rows = windows.withColumn("seq_id", F.concat_ws("|", "chrom", "start", "end", "strand"))
    cut = tracks.sliding_windows(rows.withColumn("seq", F.upper("seq")) if upper else rows)
    scored = scoring.score_windows(cut, scorer, "seq_id")
    lengths = rows.select("seq_id", F.length("seq").alias("n"))
    flat = scored.select("seq_id", "window_start", F.posexplode("cuts").alias("i", "value")).withColumn("pos", F.col("window_start") + F.col("i")).join(lengths, "seq_id").filter(F.col("pos") < F.col("n"))
    added = tracks.overlap_add(flat)
    added = tracks.smoothed(added, "total", "_total") if smooth else added.withColumn("_total", F.col("total"))
    profile = added.select("seq_id", "pos", (F.col("_total") / F.col("coverage")).alias("v")).groupBy("seq_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda x: x["v"]).alias("profile"))
    return rows.select("seq_id", "chrom", "start", "end", "strand").join(profile, "seq_id").drop("seq_id")


def predict_polya(spark: SparkSession, path: str, scorer: Callable, out: str, prefix: str = "peaks", mode: str = "bedgraph", least: float = 0.01) -> bool:
    """Lines of the profiles of a window file, in a folder <out>/<prefix>.<mode>; False, and nothing written, if there are none."""
    lines = sinks.peak_lines(tracks.profile_lines(polya_profiles(text.read_windows(spark, path), scorer), least), mode)
    if lines.isEmpty():
        return False
    lines.write.mode("overwrite").text(str(Path(out) / f"{prefix}.{mode}"))
    return True


def fill_gaps(spark: SparkSession, chain_path: str, target: str, query: str, out: str | None = None, align: Callable | None = None, unmask: bool = False, least_patch: int = 2000, least_score: int = 0, least_target: int = 0, least_query: int = 0, **limits) -> tuple[DataFrame, DataFrame]:
    """Chains, and their blocks with patches in the gaps that `align` fills (unset: our own aligner); written to `out`, if given, as chain text."""
    head, blocks = text.read_chains(spark, chain_path)
    eligible = chains.wanted(head, least_score, least_target, least_query)
    jobs = chains.gap_jobs(eligible, blocks.join(eligible.select("chain_id"), "chain_id", "left_semi"), **limits)
    base = (lambda c: F.upper(c)) if unmask else (lambda c: c)
    t_cut = genome.cut_any(jobs.withColumnRenamed("t_name", "chrom").withColumn("_a", F.col("t_lo") - 1), paths.read_genome(spark, target), "_a", "t_hi", "t_seq").drop("chrom")
    q_at = t_cut.withColumnRenamed("q_name", "chrom").withColumn("_a", F.col("q_lo") - 1)
    both = genome.cut_any(q_at, paths.read_genome(spark, query), "_a", "q_hi", "q_seq").withColumn("t_seq", base(F.col("t_seq")))
    both = both.withColumn("q_seq", base(F.when(F.col("q_strand") == "-", sequence.reverse_complement(F.col("q_seq"))).otherwise(F.col("q_seq"))))
    both = both.filter("t_seq is not null and q_seq is not null")
    best = chains.best_patches(chains.realigned(both, align) if align else alignment.aligned_gaps(both), least_patch)
    done = chains.patched(chains.coordinates(blocks, head), best)
    if out:
        sinks.chain_lines(head, done).write.mode("overwrite").text(out)
    return head, done
