"""Genomes (chrom, seq): sizes, tiles, strands, adjacent pairs, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import normalized, reverse_complement


def sizes(genome: DataFrame, least: int = 0) -> DataFrame:
    return genome.select("chrom", F.length("seq").cast("bigint").alias("size")).filter(F.col("size") >= least)


def tiles(genome: DataFrame, chunk: int = 6_000_000, flank: int = 50_000, least: int = 500, n_to_a: bool = True) -> DataFrame:
    """chrom, chunk_index (from 0), start, end, flank_start, flank_end and seq (with flanks) of each chunk of contigs of `least` or more.

    A contig is cut into chunks in one pass; flanks come from as many chunks beside a chunk as they reach over.
    """
    if chunk <= 0 or flank < 0:
        raise ValueError("chunk must be over 0, and flank not under it")
    length, i = F.length("seq").cast("bigint"), F.col("chunk_index")
    near = -(-flank // chunk)
    cut = genome.filter((length >= least) & (length > 0)).select("chrom", length.alias("_n"), F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)).alias("_cut"))
    part = lambda at: F.coalesce(F.get("_cut", at), F.lit(""))

    def flanked(_, at):
        before, after = (F.concat(*[part(at + k) for k in side]) if near else F.lit("") for side in (range(-near, 0), range(1, near + 1)))
        return F.concat(F.right(before, F.lit(flank)), part(at), F.left(after, F.lit(flank)))

    rows = cut.select("chrom", "_n", F.posexplode(F.transform("_cut", flanked)).alias("chunk_index", "seq")).withColumn("start", i.cast("bigint") * chunk)
    rows = rows.withColumn("end", F.least(F.col("start") + chunk, "_n")).withColumn("flank_start", F.greatest(F.lit(0), F.col("start") - flank)).withColumn("flank_end", F.least("_n", F.col("end") + flank))
    return rows.select("chrom", "chunk_index", "start", "end", "flank_start", "flank_end", (normalized(F.col("seq")) if n_to_a else F.col("seq")).alias("seq"))


def both_strands(rows: DataFrame, revcomp_minus: bool = False) -> DataFrame:
    """Each row once for each strand, with one sequence for both unless `revcomp_minus`."""
    twice = rows.withColumn("strand", F.explode(F.array(F.lit("+"), F.lit("-"))))
    return twice.withColumn("seq", F.when(F.col("strand") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq"))) if revcomp_minus else twice


def pair_counts(genome: DataFrame, length: int = 1 << 14) -> DataFrame:
    """motif and n of all adjacent pairs without N, upper case, each counted for itself and for its reverse complement.

    Sequences are cut into pieces that are dealt to all tasks, with the letter that follows, so that a long contig is no
    task's own work. In a piece, pairs of unlike letters can't overlap themselves, so what goes when they are removed
    tells how many there are; a letter's pairs with itself are the rest of the pairs that it begins. Only pairs with
    letters beyond A, C, G, T and N are taken out one by one. One partial sum a task leaves it.
    """
    cut = pieces(genome.select("chrom", "seq"), length, 1).filter(F.length("piece") > 1).repartition("chrom", "tile").select(F.upper("piece").alias("_s"))
    odd = F.col("_s").rlike("[^ACGTN]")
    rows = cut.select("_s", odd.alias("_odd"), F.when(odd, F.regexp_replace("_s", "[^ACGT]", "N")).otherwise(F.col("_s")).alias("s"))
    s, head = F.col("s"), F.substring("s", F.lit(1), F.length("s") - 1)
    count = lambda c, x: F.octet_length(c) - F.octet_length(F.replace(c, F.lit(x), F.lit("")))
    rows = rows.select("_s", "_odd", *[F.floor(count(s, x + y) / 2).alias(x + y) for x in "ACGT" for y in "ACGTN" if x != y], *[count(head, x).alias(x) for x in "ACGT"])
    one = lambda pair, n: F.struct(F.lit(pair).alias("pair"), n.cast("bigint").alias("n"))
    each = []
    for x in "ACGT":
        others = [F.col(x + y) for y in "ACGTN" if y != x]
        each += [one(x + y, F.col(x + y)) for y in "ACGT" if y != x] + [one(x + x, F.col(x) - others[0] - others[1] - others[2] - others[3])]
    letters = F.split("_s", "")
    beside = F.zip_with(F.slice(letters, F.lit(1), F.size(letters) - 1), F.slice(letters, F.lit(2), F.size(letters) - 1), lambda x, y: F.concat(x, y))
    rare = F.transform(F.filter(beside, lambda p: p.rlike("[^ACGTN]")), lambda p: F.struct(p.alias("pair"), F.lit(1).cast("bigint").alias("n")))
    found = F.when(F.col("_odd"), F.concat(F.array(*each), rare)).otherwise(F.array(*each))
    pairs = rows.select(F.explode(found).alias("x")).select("x.pair", "x.n").filter((F.col("n") > 0) & ~F.contains("pair", F.lit("N"))).groupBy("pair").agg(F.sum("n").alias("n"))
    return pairs.select(F.explode(F.array("pair", reverse_complement(F.col("pair")))).alias("motif"), "n").groupBy("motif").agg(F.sum("n").alias("n"))


def pieces(genome: DataFrame, length: int = 1 << 12, reach: int = 0) -> DataFrame:
    """chrom, size, tile and piece: each sequence as pieces of `length`, with the `reach` (at most `length`) letters that follow.

    A sequence is cut in one pass over it, whatever its length; an empty one has one empty piece.
    """
    if not 0 <= reach <= length:
        raise ValueError("reach must be at most the length of a piece")
    cut = genome.select("chrom", F.length("seq").cast("bigint").alias("size"), F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{length}}}"), F.lit(0)).alias("_cut"))
    more = lambda i: F.concat(F.coalesce(F.get("_cut", i), F.lit("")), F.substring(F.coalesce(F.get("_cut", i + 1), F.lit("")), 1, reach))
    whole = F.transform(F.sequence(F.lit(0), F.greatest(F.size("_cut") - 1, F.lit(0))), more)
    return cut.select("chrom", "size", F.posexplode(whole).alias("tile", "piece"))


def cut(rows: DataFrame, genome: DataFrame | None, start: str = "start", end: str = "end", to: str = "seq", reach: int = 1 << 12, tiled: DataFrame | None = None) -> DataFrame:
    """`rows` with letters [start, end) of their chrom in `to`, null where those aren't within it.

    Rows meet pieces of the genome by chrom and tile, so that no row ever carries a whole sequence and no task needs
    one. Intervals may be up to `reach` long; longer ones (see cut_any), and chroms that the genome lacks, are errors.
    In place of a genome, pieces that are read as such will do (`tiled`, of max(4096, reach) letters and `reach` more).
    """
    length = max(1 << 12, reach)
    if tiled is None:
        tiled = pieces(genome, length, reach)
        sizes = genome.select(F.col("chrom").alias("_chrom"), F.length("seq").cast("bigint").alias("_size"))
    else:
        sizes = tiled.filter("tile = 0").select(F.col("chrom").alias("_chrom"), F.col("size").alias("_size"))
    known = rows.join(sizes, F.col("chrom") == F.col("_chrom"), "left")
    size = F.when(F.col("_chrom").isNull(), F.raise_error(F.concat(F.lit("no such sequence: "), F.col("chrom"))).cast("bigint")).otherwise(F.col("_size"))
    known = known.withColumn("_size", size).withColumn("_tile", F.floor(F.greatest(F.col(start), F.lit(0)) / length).cast("int")).drop("_chrom")
    own = tiled.select(F.col("chrom").alias("_chrom"), F.col("tile").alias("_t"), F.col("piece").alias("_piece"))
    met = known.join(own, (F.col("chrom") == F.col("_chrom")) & (F.col("_tile") == F.col("_t")), "left")
    span = F.col(end) - F.col(start)
    letters = F.substring("_piece", (F.col(start) - F.col("_tile") * length + 1).cast("int"), span.cast("int"))
    inside = (F.col(start) >= 0) & (span >= 0) & (F.col(end) <= F.col("_size"))
    found = F.when(inside & (span > reach), F.raise_error(F.lit(f"an interval is longer than {reach}")).cast("string")).when(inside & (span == 0), F.lit("")).when(inside, letters)
    return met.withColumn(to, found).drop("_chrom", "_t", "_piece", "_tile", "_size")


def cut_any(rows: DataFrame, genome: DataFrame, start: str = "start", end: str = "end", to: str = "seq", reach: int = 1 << 12) -> DataFrame:
    """As cut, for intervals of any length: those over `reach` are put together from the pieces that they reach over.

    Each different long interval is cut piece by piece where the pieces are, and put together once, in order.
    """
    span = F.col(end) - F.col(start)
    short = cut(rows.filter(~(span > reach) | span.isNull()), genome, start, end, to, reach)
    long = rows.filter(span > reach)
    length = max(1 << 12, reach)
    lo, hi = F.col("_lo"), F.col("_hi")
    asked = long.filter(F.col(start) >= 0).select(F.col("chrom").alias("_of"), F.col(start).alias("_lo"), F.col(end).alias("_hi")).distinct()
    asked = asked.withColumn("_t", F.explode(F.sequence(F.floor(lo / length).cast("int"), F.floor((hi - 1) / length).cast("int"))))
    met = asked.join(pieces(genome, length, 0), (F.col("_of") == F.col("chrom")) & (F.col("_t") == F.col("tile")))
    begin = F.greatest(lo - F.col("_t") * length, F.lit(0))
    part = F.substring("piece", (begin + 1).cast("int"), (hi - F.col("_t") * length - begin).cast("int"))
    whole = met.groupBy("_of", "_lo", "_hi").agg(F.max("size").alias("_size"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_t", part.alias("part")))), lambda x: x["part"]), "").alias("_whole"))
    whole = whole.select("_of", "_lo", "_hi", F.when(hi <= F.col("_size"), F.col("_whole")).alias(to))
    there = genome.select(F.col("chrom").alias("_chrom")).distinct()
    known = long.join(there, F.col("chrom") == F.col("_chrom"), "left")
    known = known.withColumn("chrom", F.when(F.col("_chrom").isNull(), F.raise_error(F.concat(F.lit("no such sequence: "), F.col("chrom"))).cast("string")).otherwise(F.col("chrom"))).drop("_chrom")
    same = (F.col("chrom") == F.col("_of")) & (F.col(start) == lo) & (F.col(end) == hi)
    return short.unionByName(known.join(whole, same, "left").drop("_of", "_lo", "_hi"))


def known_only(rows: DataFrame, chroms: DataFrame) -> DataFrame:
    """Rows whose chrom is in `chroms`."""
    return rows.join(chroms.select("chrom").distinct(), "chrom", "left_semi")


def missing(rows: DataFrame, chroms: DataFrame) -> DataFrame:
    """Chroms of `rows` that are not in `chroms`, each once."""
    return rows.select("chrom").distinct().join(chroms.select("chrom").distinct(), "chrom", "left_anti")
