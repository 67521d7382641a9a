"""Queries over the test tables, one or more per operator, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as q
from ..operators import alignment, annotation, calibration, chains, genome, intervals, junctions, ordering, peaks, scoring, tracks
from . import views
from .views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(with_views("junctions") + 'SELECT chr, start, "end", strand, motif, coverage, l_orderkey, l_linenumber FROM junctions WHERE "end" - start >= 50 AND annotated <> 1')
def junction_length_filter(spark, d):
    return junctions.unannotated(junctions.long_enough(views.junctions(spark, d))).select("chr", "start", "end", "strand", "motif", "coverage", "l_orderkey", "l_linenumber")


@query(
    with_views("junctions")
    + """SELECT chr, start, "end", strand, arg_min(motif, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS motif, CAST(sum(coverage) AS BIGINT) AS coverage,
       CAST(sum(multimap) AS BIGINT) AS multimap, max(overhang) AS overhang, 1 AS annotated
FROM junctions WHERE "end" - start >= 50 AND annotated <> 1 GROUP BY chr, start, "end", strand HAVING sum(coverage) >= 5"""
)
def junction_merge(spark, d):
    return junctions.merge(views.junctions(spark, d), views.JUNCTION_ORDER).select("chr", "start", "end", "strand", "motif", "coverage", "multimap", "overhang", "annotated")


@query(
    with_views("junctions")
    + """, merged AS (SELECT chr, start, "end", strand, min(row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS first, sum(coverage) AS coverage
    FROM junctions WHERE "end" - start >= 50 AND annotated <> 1 GROUP BY chr, start, "end", strand HAVING sum(coverage) >= 5)
SELECT chr, start, "end", strand, row_number() OVER (ORDER BY first) - 1 AS place FROM merged"""
)
def junction_order(spark, d):
    merged = junctions.merge(views.junctions(spark, d), views.JUNCTION_ORDER)
    return ordering.in_order(merged.select("chr", "start", "end", "strand", "first"), ["first"], "place").drop("first")


@query(with_views("sequences") + "SELECT chrom, length(seq) AS size FROM sequences WHERE length(seq) >= 50")
def chrom_sizes(spark, d):
    return genome.sizes(views.sequences(spark, d), 50)


def tiles_sql(chunk: int, flank: int) -> str:
    return f""", tiled AS (SELECT chrom, seq, length(seq) AS n, unnest(range(0, length(seq), {chunk})) AS start FROM sequences WHERE length(seq) >= 50),
tiles AS (SELECT chrom, start // {chunk} AS chunk_index, start, least(start + {chunk}, n) AS "end", greatest(0, start - {flank}) AS flank_start, least(n, least(start + {chunk}, n) + {flank}) AS flank_end,
    translate(substr(seq, CAST(greatest(0, start - {flank}) + 1 AS INT), CAST(least(n, least(start + {chunk}, n) + {flank}) - greatest(0, start - {flank}) AS INT)), 'Nn', 'AA') AS seq FROM tiled)
"""


_TILES = tiles_sql(100, 20)


def _tiles(spark, d, chunk=100, flank=20):
    return genome.tiles(views.sequences(spark, d), chunk=chunk, flank=flank, least=50)


@query(with_views("sequences") + _TILES + 'SELECT chrom, chunk_index, start, "end", flank_start, flank_end, seq FROM tiles')
def genome_tiles(spark, d):
    return _tiles(spark, d)


@query(with_views("sequences") + _TILES + """SELECT chrom || ':' || start || '-' || "end" || '(' || strand || ')' AS header, seq FROM tiles CROSS JOIN (VALUES ('+'), ('-')) s(strand)""")
def strand_duplicate(spark, d):
    twice = genome.both_strands(_tiles(spark, d))
    return twice.select(q.region_header(F.col("chrom"), F.col("start"), F.col("end"), F.col("strand")).alias("header"), "seq")


@query(with_views("sequences") + "SELECT chrom, translate(seq, 'Nn', 'AA') AS seq, upper(seq) AS upper_seq FROM sequences")
def normalize_bases(spark, d):
    return views.sequences(spark, d).select("chrom", q.normalized(F.col("seq")).alias("seq"), F.upper("seq").alias("upper_seq"))


@query(with_views("sequences") + "SELECT chrom, translate(upper(seq), 'ACGT', 'TGCA') AS complement, translate(upper(reverse(seq)), 'ACGT', 'TGCA') AS revcomp, translate(reverse(seq), 'ACGTacgt', 'TGCAtgca') AS strict_revcomp FROM sequences")
def reverse_complement(spark, d):
    s = F.col("seq")
    return views.sequences(spark, d).select("chrom", q.complement(s).alias("complement"), q.reverse_complement(s).alias("revcomp"), q.strict_reverse_complement(s).alias("strict_revcomp"))


@query(with_views("sequences", "genome_counts") + "SELECT motif, n FROM genome_counts")
def dinucleotide_counts(spark, d):
    return genome.pair_counts(views.sequences(spark, d))


@query(
    with_views("sequences")
    + """, sited AS (SELECT chrom, seq, i * 37 AS pos, CASE WHEN i % 2 = 0 THEN '+' ELSE '-' END AS strand, CASE WHEN i % 3 = 0 THEN 'D' ELSE 'A' END AS site FROM (SELECT *, unnest(range(0, length(seq) // 37 + 2)) AS i FROM sequences)),
offs AS (SELECT *, CASE WHEN (site = 'D') = (strand = '+') THEN pos ELSE pos - 1 END AS a FROM sited),
cut AS (SELECT *, CASE WHEN a >= 0 AND a + 2 <= length(seq) THEN upper(substr(seq, CAST(a + 1 AS INT), 2)) END AS pair FROM offs)
SELECT chrom, pos, strand, site, CASE WHEN strand = '-' THEN translate(reverse(pair), 'ACGT', 'TGCA') ELSE pair END AS motif FROM cut WHERE pair IS NOT NULL"""
)
def site_motif_extract(spark, d):
    """A site every 37 letters of each whole sequence, and one past its end."""
    i = lambda k: (k * 37).cast("bigint")
    kind = lambda k: (F.when(k % 2 == 0, "+").otherwise("-"), F.when(k % 3 == 0, "D").otherwise("A"))
    one = lambda k: F.struct(i(k).alias("pos"), kind(k)[0].alias("strand"), kind(k)[1].alias("site"), q.site_motif(F.col("seq"), i(k), *kind(k)).alias("motif"))
    rows = views.sequences(spark, d).select("chrom", F.explode(F.transform(F.sequence(F.lit(0), (F.length("seq") / 37).cast("int") + 1), one)).alias("x"))
    return rows.select("chrom", "x.*").filter(F.col("motif").isNotNull())


@query(
    with_views("sequences", "intervals")
    + """, asked AS (SELECT DISTINCT 'doc' || ((start // 100) % (SELECT count(*) FROM documents)) AS chrom, start * 7 + "end" AS x, ("end" - start) % 90 AS span, strand FROM intervals),
placed AS (SELECT DISTINCT a.chrom, strand, seq, x % greatest(length(seq), 1) AS start, least(x % greatest(length(seq), 1) + span, length(seq)) AS "end" FROM asked a JOIN sequences s ON a.chrom = s.chrom),
cut AS (SELECT *, substr(seq, CAST(start + 1 AS INT), CAST("end" - start AS INT)) AS piece FROM placed)
SELECT chrom, start, "end", strand, CASE WHEN strand = '-' THEN translate(reverse(piece), 'ACGTacgt', 'TGCAtgca') ELSE piece END AS seq FROM cut"""
)
def interval_sequence(spark, d):
    """Intervals spread over all sequences and over the whole of each, cut at its end."""
    g = views.sequences(spark, d)
    asked = views.intervals(spark, d).selectExpr(f"concat('doc', (start div 100) % {max(1, g.count())}) chrom", "start * 7 + `end` x", "(`end` - start) % 90 span", "strand").distinct()
    sizes = genome.sizes(g).withColumnRenamed("chrom", "_chrom")
    placed = asked.join(sizes, F.col("chrom") == F.col("_chrom")).withColumn("start", F.col("x") % F.greatest("size", F.lit(1)))
    placed = placed.select("chrom", "strand", "start", F.least(F.col("start") + F.col("span"), "size").alias("end")).distinct()
    rows = genome.cut(placed, g, reach=100)
    return rows.select("chrom", "start", "end", "strand", F.when(F.col("strand") == "-", q.strict_reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


@query(
    with_views("sequences")
    + """, asked AS (SELECT chrom, i * 50 AS start, CASE WHEN i % 3 = 0 THEN length(seq) WHEN i % 3 = 1 THEN i * 50 + 1 ELSE i * 50 + 40 * i END AS "end", seq FROM (SELECT *, unnest(range(0, length(seq) // 100 + 1)) AS i FROM sequences))
SELECT chrom, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end", CASE WHEN "end" <= length(seq) AND "end" >= start THEN substr(seq, CAST(start + 1 AS INT), CAST("end" - start AS INT)) END AS seq FROM asked"""
)
def long_intervals(spark, d):
    """Intervals of one letter to a whole sequence, and some past its end, in one call."""
    g = views.sequences(spark, d)
    i = F.col("i").cast("bigint")
    end = F.when(i % 3 == 0, F.col("n")).when(i % 3 == 1, i * 50 + 1).otherwise(i * 90)
    rows = g.select("chrom", F.length("seq").cast("bigint").alias("n"), F.explode(F.sequence(F.lit(0), F.floor(F.length("seq") / 100).cast("int"))).alias("i"))
    return genome.cut_any(rows.select("chrom", (i * 50).alias("start"), end.alias("end")), g, reach=100)


@query(
    with_views("sites")
    + """SELECT chrom || ':' || pos || '(' || strand || ')' AS site_key, chrom, pos, strand FROM sites"""
)
def site_keys(spark, d):
    keyed = views.sites(spark, d).select(q.site_key(F.col("chrom"), F.col("pos"), F.col("strand")).alias("site_key"))
    return keyed.withColumn("x", q.parsed_site_key(F.col("site_key"))).select("site_key", "x.chrom", "x.pos", "x.strand")


@query(with_views("intervals") + """SELECT DISTINCT chrom, strand, greatest(0, start - 100) AS start, "end" + 100 AS "end" FROM intervals""")
def interval_expand_dedupe(spark, d):
    return intervals.expand(views.intervals(spark, d), 100, 100)


def _merged(spark, d):
    return intervals.merge(views.intervals(spark, d).distinct())


@query(with_views("intervals", "merged") + 'SELECT chrom, strand, start, "end" FROM merged')
def interval_merge(spark, d):
    return _merged(spark, d)


@query(
    with_views("intervals", "merged")
    + """, sized AS (SELECT *, ("end" - start - 1) % 500 + 1 AS tail FROM merged),
counted AS (SELECT *, ("end" - start - tail) // 500 + CASE WHEN tail < 10 AND "end" - start > 500 THEN 0 ELSE 1 END AS n FROM sized),
cut AS (SELECT *, unnest(range(0, CAST(n AS BIGINT))) AS i FROM counted)
SELECT chrom, strand, start + i * 500 AS start, CASE WHEN i = n - 1 THEN "end" ELSE start + (i + 1) * 500 END AS "end" FROM cut"""
)
def interval_split(spark, d):
    return intervals.split(_merged(spark, d), 500)


@query(with_views("intervals", "merged") + """SELECT chrom, strand, start, "end", row_number() OVER (ORDER BY chrom || ':' || strand, start, "end") - 1 AS place FROM merged""")
def interval_order(spark, d):
    return ordering.in_order(_merged(spark, d), intervals.bucket_order(_merged(spark, d)), "place").select("chrom", "strand", "start", "end", "place")


_EXONS = """, placed AS (SELECT chain_id, block_no, coalesce(sum(size + coalesce(dt, 0)) OVER (PARTITION BY chain_id ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, size, chain_id % 2 AS odd FROM blocks),
exons AS (SELECT chain_id, block_no, CAST(start AS BIGINT) AS start, CAST(start + size AS BIGINT) AS "end", odd FROM placed)
"""


def _transcripts(spark, d):
    """Chains as transcripts: blocks are exons, the thick part is the middle half."""
    placed = chains.coordinates(views.blocks(spark, d))
    exon = F.struct(F.col("t_pos").alias("start"), (F.col("t_pos") + F.col("size")).alias("end"))
    t = placed.groupBy("chain_id").agg(F.array_sort(F.collect_list(exon)).alias("exons"), F.max(F.col("t_pos") + F.col("size")).alias("n"))
    return t.selectExpr("chain_id", "if(chain_id % 2 = 0, '+', '-') strand", "n div 4 thick_start", "(3 * n) div 4 thick_end", "exons")


@query(with_views("blocks") + _EXONS + """SELECT chain_id, "end" AS intron_start, next AS intron_end FROM (SELECT chain_id, "end", lead(start) OVER (PARTITION BY chain_id ORDER BY start, "end") AS next FROM exons) WHERE next IS NOT NULL""")
def transcript_introns(spark, d):
    return _transcripts(spark, d).select("chain_id", F.explode(intervals.introns(F.col("exons"))).alias("x")).select("chain_id", F.col("x.start").alias("intron_start"), F.col("x.end").alias("intron_end"))


@query(
    with_views("blocks")
    + _EXONS
    + """, whole AS (SELECT chain_id, max("end") AS n FROM exons GROUP BY chain_id),
parts AS (SELECT e.chain_id, CASE WHEN odd = 0 THEN greatest(start, (3 * n) // 4) ELSE start END AS part_start, CASE WHEN odd = 0 THEN "end" ELSE least("end", n // 4) END AS part_end FROM exons e JOIN whole w ON e.chain_id = w.chain_id)
SELECT chain_id, part_start, part_end FROM parts WHERE part_end > part_start"""
)
def utr_parts(spark, d):
    t = _transcripts(spark, d)
    parts = intervals.three_prime_parts(F.col("exons"), F.col("strand"), F.col("thick_start"), F.col("thick_end"))
    return t.select("chain_id", F.explode(parts).alias("x")).select("chain_id", F.col("x.start").alias("part_start"), F.col("x.end").alias("part_end"))


_BIN = "CASE " + " ".join(f"WHEN score < CAST({e} AS FLOAT) THEN {k}" for k, e in enumerate(calibration.EDGES[1:-1])) + f" ELSE {len(calibration.EDGES) - 2} END"
_SCORED = ", scored AS (SELECT * FROM sites WHERE score >= CAST(0.001 AS FLOAT))"


@query(with_views("sites") + _SCORED + f"SELECT chrom, pos, strand, {_BIN} AS bin FROM scored")
def score_bins(spark, d):
    return calibration.scored(views.sites(spark, d)).select("chrom", "pos", "strand", calibration.score_bin(F.col("score")).alias("bin"))


@query(
    with_views("sites", "annotated") + _SCORED + "SELECT s.chrom, s.pos, s.strand, EXISTS (SELECT 1 FROM annotated a WHERE a.chrom = s.chrom AND a.pos = s.pos AND a.strand = s.strand) AS annotated FROM scored s"
)
def annotated_flag(spark, d):
    return calibration.flagged(calibration.scored(views.sites(spark, d)), views.annotated(spark, d)).select("chrom", "pos", "strand", "annotated")


_ANNOTATED_COUNTS = """, site_motifs AS (SELECT site, chrom, pos, strand, min(motif) AS motif FROM annotated GROUP BY site, chrom, pos, strand), annotated_counts AS (SELECT site, motif, count(*) AS n FROM site_motifs GROUP BY site, motif)"""


@query(with_views("sites", "annotated") + _ANNOTATED_COUNTS + "SELECT site, motif, n FROM annotated_counts")
def distinct_site_motifs(spark, d):
    known = views.annotated(spark, d)
    return calibration.distinct_motifs(known, ("site",))


@query(
    with_views("sites", "annotated", "sequences", "genome_counts")
    + _ANNOTATED_COUNTS
    + """, donors AS (SELECT * FROM annotated_counts WHERE site = 'D')
SELECT coalesce(g.motif, a.motif) AS motif, round(CASE WHEN g.n > 0 THEN coalesce(a.n, 0)::DOUBLE / g.n ELSE 0.0 END, 12) AS p_null FROM genome_counts g FULL OUTER JOIN donors a ON g.motif = a.motif"""
)
def null_profile(spark, d):
    donors = views.annotated(spark, d).filter(F.col("site") == "D")
    return calibration.null_profile(genome.pair_counts(views.sequences(spark, d)), calibration.distinct_motifs(donors)).select("motif", F.round("p_null", 12).alias("p_null"))


_BINS = (
    _SCORED
    + _ANNOTATED_COUNTS
    + f""", kinds AS (SELECT unnest(['D', 'A']) AS site),
binned AS (SELECT s.site, s.motif, {_BIN} AS bin, count(*) AS t, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM annotated a WHERE a.site = s.site AND a.chrom = s.chrom AND a.pos = s.pos AND a.strand = s.strand)) AS r FROM scored s GROUP BY ALL),
motifs AS (SELECT DISTINCT site, motif FROM (SELECT k.site, g.motif FROM genome_counts g CROSS JOIN kinds k UNION ALL SELECT site, motif FROM annotated_counts UNION ALL SELECT site, motif FROM binned)),
grid AS (SELECT site, motif, unnest(range(0, 14)) AS bin FROM motifs),
filled AS (SELECT g.site, g.motif, g.bin, coalesce(b.t, 0) AS t, coalesce(b.r, 0) AS r, coalesce(c.n, 0) AS genome, coalesce(a.n, 0) AS known
    FROM grid g LEFT JOIN binned b ON b.site = g.site AND b.motif = g.motif AND b.bin = g.bin LEFT JOIN genome_counts c ON c.motif = g.motif LEFT JOIN annotated_counts a ON a.site = g.site AND a.motif = g.motif),
rest AS (SELECT *, greatest(0, genome - sum(t) OVER (PARTITION BY site, motif)) AS more, greatest(0, known - sum(r) OVER (PARTITION BY site, motif)) AS unfound FROM filled),
bins AS (SELECT site, motif, bin, CAST(t + CASE WHEN bin = 0 THEN more ELSE 0 END AS BIGINT) AS n_total, CAST(r + CASE WHEN bin = 0 THEN least(unfound, more) ELSE 0 END AS BIGINT) AS n_real FROM rest)
"""
)


@query(with_views("sites", "annotated", "sequences", "genome_counts") + _BINS + "SELECT site, motif, bin, n_total, n_real, round(CASE WHEN n_total > 0 THEN n_real::DOUBLE / n_total ELSE 0.0 END, 12) AS p FROM bins")
def calibration_bins(spark, d):
    counts, known, scored = genome.pair_counts(views.sequences(spark, d)), views.annotated(spark, d), calibration.scored(views.sites(spark, d))
    site = ("site",)
    made = calibration.bins(calibration.flagged(scored, known, site), calibration.by_site(counts), calibration.distinct_motifs(known, site), site)
    return made.select("site", "motif", "bin", "n_total", "n_real", F.round("p", 12).alias("p"))


@query(
    with_views("sites", "annotated", "sequences", "genome_counts")
    + _BINS
    + f""", nulls AS (SELECT m.site, m.motif, CASE WHEN g.n > 0 THEN coalesce(a.n, 0)::DOUBLE / g.n ELSE 0.0 END AS q FROM motifs m LEFT JOIN genome_counts g ON g.motif = m.motif LEFT JOIN annotated_counts a ON a.site = m.site AND a.motif = m.motif),
rated AS (SELECT s.chrom, s.pos, s.strand, s.site, s.motif, CASE WHEN b.n_total > 0 THEN b.n_real::DOUBLE / b.n_total ELSE 0.0 END AS p, n.q FROM (SELECT *, {_BIN} AS bin FROM scored) s
    JOIN bins b ON b.site = s.site AND b.motif = s.motif AND b.bin = s.bin JOIN nulls n ON n.site = s.site AND n.motif = s.motif)
SELECT chrom, pos + CASE WHEN (site = 'A') = (strand = '+') THEN 1 ELSE 0 END AS coordinate, strand, site, motif,
       CAST(CASE WHEN p <= 0 THEN -4 WHEN q <= 0 THEN 13 ELSE greatest(-4, least(13, round(2 * log2(p / q)))) END AS INT) AS derived_score FROM rated"""
)
def derived_scores(spark, d):
    return calibration.derive_all(views.sites(spark, d), views.annotated(spark, d), genome.pair_counts(views.sequences(spark, d)))


@query(ORACLE_SQL["derived_scores"].replace("SELECT chrom, pos + CASE", ", derived AS (SELECT chrom, pos + CASE", 1) + """)
SELECT chrom, coordinate, strand, site, derived_score, row_number() OVER (ORDER BY chrom, coordinate, strand <> '+', motif, site <> 'D') - 1 AS place FROM derived""")
def derived_order(spark, d):
    return ordering.in_order(derived_scores(spark, d), calibration.output_order(), "place").select("chrom", "coordinate", "strand", "site", "derived_score", "place")


@query(with_views("tracks") + "SELECT vec_id, i, CASE WHEN abs(value) >= 0.001 THEN round_even(abs(value), 4) ELSE 0.0 END AS p FROM tracks")
def prob_floor_round(spark, d):
    return views.tracks(spark, d).select("vec_id", "i", tracks.floored(F.abs("value"), 0.001, 4).alias("p"))


@query(with_views("tracks") + "SELECT seq_id, i, round(avg(value), 6) AS mean FROM tracks GROUP BY seq_id, i")
def ensemble_mean(spark, d):
    return tracks.ensemble_mean(views.tracks(spark, d), ["seq_id", "i"]).select("seq_id", "i", F.round("mean", 6).alias("mean"))


@query(
    with_views("sequences")
    + """, starts AS (SELECT chrom, seq, unnest(range(0, CASE WHEN length(seq) <= 205 THEN 1 ELSE CAST(ceil((length(seq) - 205) / 10.0) AS BIGINT) * 10 + 1 END, 10)) AS window_start FROM sequences WHERE length(seq) > 0)
SELECT chrom, window_start, rpad(substr(seq, CAST(window_start + 1 AS INT), 205), 205, 'X') AS window FROM starts"""
)
def sliding_windows(spark, d):
    return tracks.sliding_windows(views.sequences(spark, d)).select("chrom", "window_start", "window")


_ADDED = ", added AS (SELECT seq_id, pos, sum(value) AS total, count(*) AS coverage FROM tracks GROUP BY seq_id, pos)"


@query(with_views("tracks") + _ADDED + "SELECT seq_id, pos, round(total, 6) AS total, coverage, round(total / coverage, 6) AS mean FROM added")
def overlap_add(spark, d):
    return tracks.overlap_add(views.tracks(spark, d)).select("seq_id", "pos", F.round("total", 6).alias("total"), "coverage", F.round("mean", 6).alias("mean"))


@query(
    with_views("tracks")
    + """, added AS (SELECT seq_id, pos, sum(value) AS total, sum(value * value) AS squares, count(*) AS coverage FROM tracks GROUP BY seq_id, pos), n AS (SELECT seq_id, count(DISTINCT vec_id) AS n FROM tracks GROUP BY seq_id)
SELECT a.seq_id, pos, round(sqrt(greatest(0, squares - 2 * total * total / coverage + n * (total / coverage) * (total / coverage)) / coverage), 5) AS spread FROM added a JOIN n ON a.seq_id = n.seq_id"""
)
def overlap_spread(spark, d):
    rows = views.tracks(spark, d)
    n = rows.groupBy("seq_id").agg(F.countDistinct("vec_id").alias("n"))
    return tracks.overlap_add(rows).join(n, "seq_id").select("seq_id", "pos", F.round(tracks.spread(F.col("n")), 5).alias("spread"))


_TAPS = " + ".join(f"{w} * coalesce(sum(total) OVER (PARTITION BY seq_id ORDER BY pos RANGE BETWEEN {abs(k - 6)} {'PRECEDING' if k <= 6 else 'FOLLOWING'} AND {abs(k - 6)} {'PRECEDING' if k <= 6 else 'FOLLOWING'}), 0)" for k, w in enumerate(tracks.KERNEL))


@query(with_views("tracks") + _ADDED + f"SELECT seq_id, pos, round(({_TAPS}) / coverage, 6) AS value FROM added")
def smooth_profile(spark, d):
    added = tracks.smoothed(tracks.overlap_add(views.tracks(spark, d)), "total", "smooth", tile=32)
    return added.select("seq_id", "pos", F.round(F.col("smooth") / F.col("coverage"), 6).alias("value"))


@query(
    with_views("tracks")
    + """SELECT 'chr' || seq_id AS chrom, vec_id, line_start, line_start + 1 AS line_end, value, 'peak_' || k AS name FROM (
    SELECT *, CASE WHEN vec_id % 2 = 0 THEN i ELSE 63 - i END AS k, CASE WHEN vec_id % 2 = 0 THEN vec_id * 100 + i - 1 ELSE vec_id * 100 + 63 - i END AS line_start FROM tracks) WHERE value >= 0.01"""
)
def profile_coords(spark, d):
    rows = views.table(spark, d, "embeddings").selectExpr("concat('chr', label) chrom", "vec_id * 100 start", "vec_id * 100 + 64 `end`", "if(vec_id % 2 = 0, '+', '-') strand", "transform(embedding, x -> cast(x as double)) profile")
    lines = tracks.profile_lines(rows, 0.01)
    return lines.selectExpr("chrom", "if(strand = '+', line_start + 1, line_start) div 100 vec_id", "line_start", "line_end", "value", "name")


@query(with_views("tracks") + ", ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY value DESC, i) AS r FROM tracks) SELECT vec_id, i AS peak, value AS height FROM ranked WHERE r = 1")
def profile_argmax(spark, d):
    return tracks.argmax(views.tracks(spark, d), key="vec_id", pos="i").select("vec_id", "peak", "height")


# maxima that are high enough; the highest (of equal ones the last) is kept and those near it go, until none is left; then
# how far a kept one stands over the higher of the two lowest values between it and what is higher on either side
_PEAKS_SQL = """, around AS (SELECT vec_id, i, value, lag(value) OVER w AS before, lead(value) OVER w AS after FROM tracks WINDOW w AS (PARTITION BY vec_id ORDER BY i)),
runs AS (SELECT *, count(*) FILTER (WHERE before IS NULL OR value <> before) OVER (PARTITION BY vec_id ORDER BY i) AS run FROM around),
flat AS (SELECT vec_id, run, min(i) AS a, max(i) AS b, min(value) AS value, arg_min(before, i) AS before, arg_max(after, i) AS after FROM runs GROUP BY vec_id, run),
found AS (SELECT vec_id, list({h: value, i: (a + b) // 2}) AS todo FROM flat WHERE value > before AND value > after AND value >= 0.001 GROUP BY vec_id),
step AS (SELECT vec_id, todo, list_sort(todo, 'DESC')[1] AS top FROM found
    UNION ALL SELECT vec_id, rest, list_sort(rest, 'DESC')[1] FROM (SELECT vec_id, list_filter(todo, lambda x: abs(x.i - top.i) >= 3) AS rest FROM step) WHERE len(rest) > 0),
kept AS (SELECT vec_id, top.i AS i, top.h AS h FROM step),
walls AS (SELECT k.vec_id, k.i, k.h, coalesce(max(t.i) FILTER (WHERE t.i < k.i AND t.value > k.h), -1) AS lo, coalesce(min(t.i) FILTER (WHERE t.i > k.i AND t.value > k.h), 64) AS hi FROM kept k JOIN tracks t ON t.vec_id = k.vec_id GROUP BY ALL),
lows AS (SELECT w.vec_id, w.i, w.h, min(t.value) FILTER (WHERE t.i <= w.i) AS below, min(t.value) FILTER (WHERE t.i >= w.i) AS above FROM walls w JOIN tracks t ON t.vec_id = w.vec_id AND t.i > w.lo AND t.i < w.hi GROUP BY ALL)
SELECT vec_id AS seq_id, CAST(i AS INT) AS peak FROM lows WHERE h - greatest(below, above) >= 0.01"""


@query(with_views("tracks").replace("WITH", "WITH RECURSIVE", 1) + _PEAKS_SQL)
def profile_peaks(spark, d):
    rows = views.table(spark, d, "embeddings").selectExpr("vec_id seq_id", "transform(embedding, x -> cast(x as double)) profile")
    return peaks.peaks(rows)


@query(with_views("tracks").replace("WITH", "WITH RECURSIVE", 1) + _PEAKS_SQL)
def tiled_profile_peaks(spark, d):
    """The same from a row for each position, in tiles that are shorter than a profile."""
    rows = views.table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "value"))
    return peaks.tiled_peaks(rows.withColumnRenamed("vec_id", "seq_id"), tile=16, halo=4).select("seq_id", F.col("peak").cast("int").alias("peak"))


_PLACED = """, placed AS (SELECT *, CAST(coalesce(sum(size + coalesce(dt, 0)) OVER w, 0) AS BIGINT) AS t_pos, CAST(coalesce(sum(size + coalesce(dq, 0)) OVER w, 0) AS BIGINT) AS q_pos FROM blocks
    WINDOW w AS (PARTITION BY chain_id ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query(
    with_views("blocks")
    + """, one AS (SELECT row_number() OVER (ORDER BY chain_id, block_no) - 1 AS block_no, size, coalesce(dt, 1) AS dt, coalesce(dq, 2) AS dq FROM blocks)
SELECT block_no, CAST(coalesce(sum(size + dt) OVER w, 0) AS BIGINT) AS t_pos, CAST(coalesce(sum(size + dq) OVER w, 0) AS BIGINT) AS q_pos FROM one WINDOW w AS (ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
)
def one_long_chain(spark, d):
    """All blocks as one chain, whose positions are summed by bins."""
    rows = ordering.in_order(views.blocks(spark, d).fillna({"dt": 1, "dq": 2}), ["chain_id", "block_no"], "_place")
    one = rows.select(F.lit(0).cast("bigint").alias("chain_id"), F.col("_place").alias("block_no"), "size", "dt", "dq")
    return chains.coordinates(one, bin=512).select("block_no", "t_pos", "q_pos")


@query(with_views("blocks") + _PLACED + "SELECT chain_id, block_no, t_pos, q_pos FROM placed")
def chain_coords(spark, d):
    return chains.coordinates(views.blocks(spark, d)).select("chain_id", "block_no", "t_pos", "q_pos")


_CHAINS = """, chain_rows AS (SELECT chain_id, sum(size) AS score, CAST(1000 + max(t_pos + size) - 0 AS BIGINT) AS t_end, CAST(500 + max(q_pos + size) AS BIGINT) AS q_end, CASE WHEN chain_id % 2 = 0 THEN '+' ELSE '-' END AS q_strand, CAST(max(q_pos + size) + 1000 AS BIGINT) AS q_size FROM placed GROUP BY chain_id)"""


def _chains(spark, d):
    """Chains of the blocks, with the target from 1000 and the query from 500 on."""
    placed = chains.coordinates(views.blocks(spark, d))
    rows = placed.groupBy("chain_id").agg(F.sum("size").alias("score"), F.max(F.col("t_pos") + F.col("size")).alias("t"), F.max(F.col("q_pos") + F.col("size")).alias("q"))
    return rows.selectExpr("chain_id", "score", "'t' t_name", "1000L t_start", "1000 + t t_end", "'q' q_name", "q + 1000 q_size", "if(chain_id % 2 = 0, '+', '-') q_strand", "500L q_start", "500 + q q_end")


@query(with_views("blocks") + _PLACED + _CHAINS + "SELECT chain_id, CAST(score AS BIGINT) AS score FROM chain_rows WHERE score >= 100 AND t_end - 1000 >= 200 AND q_end - 500 >= 150")
def chain_filter(spark, d):
    return chains.wanted(_chains(spark, d), 100, 200, 150).select("chain_id", "score")


@query(with_views("blocks") + "SELECT chain_id, block_no, size, dt, dq FROM blocks WHERE dt BETWEEN 10 AND 100000 AND dq BETWEEN 10 AND 100000")
def chain_gaps(spark, d):
    return chains.gaps(views.blocks(spark, d))


@query(
    with_views("blocks")
    + _PLACED
    + _CHAINS
    + """SELECT p.chain_id, block_no, 1000 + t_pos + size + 1 AS t_lo, 1000 + t_pos + size + dt AS t_hi,
    CASE WHEN q_strand = '-' THEN q_size - (500 + q_pos + size + dq) + 1 ELSE 500 + q_pos + size + 1 END AS q_lo, CASE WHEN q_strand = '-' THEN q_size - (500 + q_pos + size) ELSE 500 + q_pos + size + dq END AS q_hi
FROM placed p JOIN chain_rows c ON p.chain_id = c.chain_id WHERE dt BETWEEN 10 AND 100000 AND dq BETWEEN 10 AND 100000"""
)
def chain_gap_jobs(spark, d):
    return chains.gap_jobs(_chains(spark, d), views.blocks(spark, d)).select("chain_id", "block_no", "t_lo", "t_hi", "q_lo", "q_hi")


@query(
    with_views("blocks")
    + _PLACED
    + """, gaps AS (SELECT *, t_pos + size AS t0, q_pos + size AS q0 FROM placed WHERE dt BETWEEN 10 AND 100000 AND dq BETWEEN 10 AND 100000 AND size * 100 >= 2000),
parts AS (SELECT b.chain_id, b.block_no, 0 AS part, b.size, CASE WHEN g.size IS NULL THEN b.dt ELSE 2 END AS dt, CASE WHEN g.size IS NULL THEN b.dq ELSE 3 END AS dq FROM blocks b LEFT JOIN gaps g ON b.chain_id = g.chain_id AND b.block_no = g.block_no
    UNION ALL SELECT chain_id, block_no, 1, 2, 1, 0 FROM gaps
    UNION ALL SELECT chain_id, block_no, 2, 3, dt - 8, dq - 8 FROM gaps)
SELECT chain_id, block_no, part, size, dt, dq FROM parts"""
)
def gap_patch(spark, d):
    placed = chains.coordinates(views.blocks(spark, d))
    wide = chains.gaps(placed).selectExpr("chain_id", "block_no", "t_pos + size t0", "q_pos + size q0", "size * 100 score")
    inner = "array(named_struct('size', 2L, 'dt', 1L, 'dq', 0L), named_struct('size', 3L, 'dt', cast(null as bigint), 'dq', cast(null as bigint)))"
    first = wide.selectExpr("chain_id", "block_no", "0 rank", "score", "t0 + 2 t_start", "t0 + 8 t_end", "q0 + 3 q_start", "q0 + 8 q_end", f"{inner} blocks")
    second = first.withColumn("rank", F.lit(1)).withColumn("score", F.col("score") + 5000)  # only the first counts
    return chains.patched(placed, chains.best_patches(first.unionAll(second)))


def edited_gaps(spark, d, placed: DataFrame) -> DataFrame:
    """Gaps with t0, q0 and letters: the target's are of a document, the query's the same ones with a piece more or less in the
    middle, as long as the gap's two sides differ, and another letter in every 13th place. Gaps longer than their document go."""
    g = views.sequences(spark, d)
    wide = chains.gaps(placed).select("chain_id", "block_no", "dt", "dq", (F.col("t_pos") + F.col("size")).alias("t0"), (F.col("q_pos") + F.col("size")).alias("q0"))
    asked = wide.withColumn("chrom", F.concat(F.lit("doc"), F.col("chain_id") % max(1, g.count())))
    sizes = genome.sizes(g).withColumnRenamed("chrom", "_chrom")
    asked = asked.join(sizes, F.col("chrom") == F.col("_chrom")).filter("size >= dt").withColumn("start", (F.col("chain_id") * 31 + F.col("block_no") * 97) % (F.col("size") - F.col("dt") + 1))
    cut = genome.cut(asked.withColumn("end", F.col("start") + F.col("dt")).drop("_chrom", "size"), g, to="t_seq", reach=120)
    half = "int(least(dt, dq) div 2)"
    more = "if(dq > dt, substr(repeat(reverse(t_seq), int(dq div dt) + 1), 1, int(dq - dt)), '')"
    query = F.expr(f"concat(substr(t_seq, 1, {half}), {more}, right(t_seq, int(least(dt, dq)) - {half}))")
    return cut.withColumn("q_seq", F.regexp_replace(query, "(.{12}).", "$1T"))


@query()
def gap_realignment(spark, d):
    """All wide gaps aligned anew and patched into their chains; tested against a plain program, as SQL is too slow for one."""
    placed = chains.coordinates(views.blocks(spark, d))
    return chains.patched(placed, chains.best_patches(alignment.aligned_gaps(edited_gaps(spark, d, placed))))


@query(with_views("sites") + "SELECT chrom, pos FROM sites WHERE chrom IN (SELECT event_type FROM events WHERE value > 490)")
def chrom_semi(spark, d):
    known = views.table(spark, d, "events").filter("value > 490").select(F.col("event_type").alias("chrom"))
    return genome.known_only(views.sites(spark, d), known).select("chrom", "pos")


@query(with_views("sequences") + "SELECT DISTINCT 'doc' || (event_id % 2000) AS chrom FROM events WHERE 'doc' || (event_id % 2000) NOT IN (SELECT chrom FROM sequences)")
def chrom_missing(spark, d):
    asked = views.table(spark, d, "events").selectExpr("concat('doc', event_id % 2000) chrom")
    return genome.missing(asked, views.sequences(spark, d))


@query(with_views("sites") + "SELECT chrom, pos, strand FROM sites WHERE strand = '+' UNION SELECT chrom, pos, strand FROM sites WHERE strand = '-'")
def strand_union(spark, d):
    rows = views.sites(spark, d).select("chrom", "pos", "strand")
    return calibration.united(rows.filter("strand = '+'"), rows.filter("strand = '-'"))


_WINDOWS = """, starts AS (SELECT chrom, seq, unnest(range(0, CASE WHEN length(seq) <= 205 THEN 1 ELSE CAST(ceil((length(seq) - 205) / 10.0) AS BIGINT) * 10 + 1 END, 10)) AS window_start FROM sequences WHERE length(seq) > 0),
windows AS (SELECT chrom, window_start, rpad(substr(seq, CAST(window_start + 1 AS INT), 205), 205, 'X') AS w FROM starts)
"""


@query(with_views("sequences") + _WINDOWS + "SELECT chrom AS seq_id, count(*) AS n, round(avg((205 - length(translate(w, 'AT', ''))) / 205.0::DOUBLE), 6) AS iso FROM windows GROUP BY chrom")
def model_score_stub(spark, d):
    windows = tracks.sliding_windows(views.sequences(spark, d)).withColumnRenamed("chrom", "seq_id")
    scored = scoring.score_windows(windows, scoring.composition_scorer, "seq_id")
    return scored.groupBy("seq_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("iso"), 6).alias("iso"))


@query(with_views("sequences") + _TILES + """SELECT chrom || ':' || start || '-' || "end" || '(+)' AS header, chrom, start, "end", '+' AS strand FROM tiles""")
def region_headers(spark, d):
    head = _tiles(spark, d).select(q.region_header(F.col("chrom"), F.col("start"), F.col("end"), F.lit("+")).alias("header"))
    return head.withColumn("x", q.parsed_region_header(F.col("header"))).select("header", "x.chrom", "x.start", "x.end", "x.strand")


@query(with_views("sites") + "SELECT chrom, pos, strand, site, CAST(pos % 1000 + 0.5 AS FLOAT) AS score, motif FROM sites WHERE pos % 7 <> 0")
def scored_records(spark, d):
    """Lines of scored sites, every seventh of which lacks a field and is left out."""
    line = "concat_ws('\\t', concat(chrom, ':', pos, '(', strand, ')'), site, concat(pos % 1000, '.5'), lower(motif))"
    lines = views.sites(spark, d).selectExpr(f"if(pos % 7 = 0, 'x\\ty', {line}) line")
    return lines.select(q.parsed_scored_site(F.col("line")).alias("x")).filter(F.col("x").isNotNull()).select("x.*")


@query(with_views("sequences") + "SELECT chrom, regexp_replace(chrom || ' /' || (length(seq) % 5), '[^A-Za-z0-9._-]', '_', 'g') AS file, repeat('N', 50) || seq || repeat('N', 50) AS padded FROM sequences")
def padded_sequences(spark, d):
    name = F.concat("chrom", F.lit(" /"), (F.length("seq") % 5).cast("string"))
    return views.sequences(spark, d).select("chrom", q.file_safe(name).alias("file"), q.padded(F.col("seq"), 50).alias("padded"))


@query(with_views("tracks") + "SELECT vec_id, i, round(ln(p / (1 - p)), 6) AS logit FROM (SELECT vec_id, i, 0.001 + 0.998 * abs(value) / (1 + abs(value)) AS p FROM tracks)")
def logits(spark, d):
    rows = views.tracks(spark, d).withColumn("p", 0.001 + 0.998 * F.abs("value") / (1 + F.abs("value")))
    return rows.select("vec_id", "i", F.round(q.logit(F.col("p")), 6).alias("logit"))


@query(
    with_views("tracks")
    + """, cores AS (SELECT vec_id, i, value, least(14, vec_id) AS before, 14 - least(14, vec_id) AS after FROM tracks)
SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN i - before ELSE 63 - before - i END AS place, value FROM cores
WHERE CASE WHEN vec_id % 2 = 0 THEN i >= before AND i < 64 - after ELSE i >= after AND i < 64 - before END"""
)
def chunk_cores(spark, d):
    """Each embedding as the values of a chunk of 50 from vec_id on, with flanks of up to 14 as far as there is room."""
    rows = views.table(spark, d, "embeddings").selectExpr("vec_id", "if(vec_id % 2 = 0, '+', '-') strand", "transform(embedding, x -> cast(x as double)) v")
    rows = rows.withColumn("f", tracks.flanks(F.col("vec_id"), F.col("vec_id") + 50, F.size("v").cast("bigint"), 14))
    return rows.select("vec_id", F.posexplode(tracks.core(F.col("v"), F.col("f.before"), F.col("f.after"), F.col("strand"))).alias("place", "value"))


@query(
    with_views("blocks", "sequences")
    + _EXONS
    + """, homes AS (SELECT DISTINCT chain_id, 'doc' || (chain_id % (SELECT count(*) FROM documents)) AS chrom FROM exons),
moved AS (SELECT h.chain_id, h.chrom, (h.chain_id * 131) % greatest(length(seq), 1) AS way FROM homes h JOIN sequences s ON s.chrom = h.chrom),
nexts AS (SELECT *, lead(start) OVER (PARTITION BY chain_id ORDER BY start, "end") AS next FROM exons),
gaps AS (SELECT DISTINCT m.chrom, CASE WHEN m.chain_id % 2 = 0 THEN '+' ELSE '-' END AS strand, "end" + way AS a, next + way AS b FROM nexts e JOIN moved m ON m.chain_id = e.chain_id WHERE next IS NOT NULL),
ends AS (SELECT chrom, strand, CASE strand WHEN '+' THEN 'D' ELSE 'A' END AS site, a AS pos, a AS spot FROM gaps
    UNION ALL SELECT chrom, strand, CASE strand WHEN '+' THEN 'A' ELSE 'D' END, CASE strand WHEN '+' THEN b - 1 ELSE b END, b - 2 FROM gaps),
cut AS (SELECT e.*, upper(substr(seq, CAST(spot + 1 AS INT), 2)) AS pair FROM ends e JOIN sequences s ON s.chrom = e.chrom WHERE spot >= 0 AND spot + 2 <= length(seq))
SELECT chrom, pos, strand, site, CASE strand WHEN '-' THEN translate(reverse(pair), 'ACGT', 'TGCA') ELSE pair END AS motif FROM cut"""
)
def annotated_sites(spark, d):
    """Sites of transcripts that are spread over all sequences, each from somewhere in the whole of its sequence on."""
    g = views.sequences(spark, d)
    known = _transcripts(spark, d).withColumn("chrom", F.concat(F.lit("doc"), (F.col("chain_id") % max(1, g.count())).cast("string")))
    sizes = genome.sizes(g).withColumnRenamed("chrom", "_chrom")
    way = (F.col("chain_id") * 131) % F.greatest("size", F.lit(1))
    moved = known.join(sizes, F.col("chrom") == F.col("_chrom")).withColumn("exons", F.transform("exons", lambda e: F.struct((e["start"] + way).alias("start"), (e["end"] + way).alias("end"))))
    return annotation.splice_sites(moved.drop("_chrom", "size"), g)


#: A peak every 100 letters of each whole sequence; those too near an end have no window.
_PEAK_WINDOWS = """, peaks AS (SELECT chrom, seq, unnest(range(0, length(seq) + 1, 100)) AS peak FROM sequences WHERE seq IS NOT NULL), inner_peaks AS (SELECT * FROM peaks WHERE peak > 75 AND peak < length(seq) - 150),
shifted AS (SELECT *, peak - 80 - unnest(range(0, 30, 2)) AS window_start FROM inner_peaks),
cut AS (SELECT chrom, peak, window_start, substr(repeat('X', 35) || seq || repeat('X', 35), CAST(window_start + 36 AS INT), 205) AS w FROM shifted WHERE window_start + 35 >= 0),
windows AS (SELECT * FROM cut WHERE length(w) = 205)
"""


def _peaks(spark, d):
    return views.sequences(spark, d).select("chrom", F.explode(F.sequence(F.lit(0), F.length("seq"), F.lit(100))).alias("peak"))


@query(with_views("sequences") + _PEAK_WINDOWS + "SELECT chrom, CAST(peak AS INT) AS peak, CAST(window_start AS INT) AS window_start, w AS window FROM windows")
def peak_windows(spark, d):
    return scoring.peak_windows(_peaks(spark, d), views.sequences(spark, d)).select("chrom", "peak", "window_start", "window")


def _peak_scores_sql(pick: str, value: str) -> str:
    return (
        with_views("sequences")
        + _PEAK_WINDOWS
        + f""", counted AS (SELECT chrom, peak, (205 - length(translate(w, 'AT', ''))) AS n, (30 - length(translate(substr(w, 78, 30), 'AT', ''))) AS near FROM windows),
rated AS (SELECT chrom, peak, n / 205.0::DOUBLE AS iso, near / greatest(n + 1 - n / 205.0::DOUBLE, 1e-9) AS cuts FROM counted),
picked AS (SELECT chrom, peak, {pick}(iso) AS iso, {pick}(cuts) AS cuts FROM rated GROUP BY chrom, peak), valued AS (SELECT chrom, peak, {value} AS v FROM picked)
SELECT p.chrom || ':' || p.peak AS seq_id, coalesce(round_even(v, 3), -10.0) AS peak_score FROM peaks p LEFT JOIN valued ON valued.chrom = p.chrom AND valued.peak = p.peak"""
    )


def _peak_scores(spark, d, **how):
    peaks = _peaks(spark, d).withColumn("seq_id", F.concat_ws(":", "chrom", "peak"))
    return scoring.peak_scores(scoring.score_windows(scoring.peak_windows(peaks, views.sequences(spark, d)), scoring.composition_scorer, near=scoring.NEAR), peaks, ["seq_id"], **how)


@query(_peak_scores_sql("max", "CASE WHEN iso + cuts > 0 AND iso + cuts < 2 THEN ln((iso + cuts) / 2 / (1 - (iso + cuts) / 2)) END"))
def peak_scores(spark, d):
    return _peak_scores(spark, d)


@query(_peak_scores_sql("avg", "iso"))
def peak_scores_mean(spark, d):
    return _peak_scores(spark, d, aggregate="mean", mode="from_iso", unit="probability")


@query(_peak_scores_sql("median", "cuts"))
def peak_scores_median(spark, d):
    return _peak_scores(spark, d, aggregate="median", mode="from_cuts", unit="probability")
