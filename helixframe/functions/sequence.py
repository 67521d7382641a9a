"""Column functions over sequences kept as strings. Positions are 0-based and half-open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def complement(seq: Column) -> Column:
    """Upper case, A, C, G, T exchanged for T, G, C, A; anything else as it is."""
    return F.translate(F.upper(seq), "ACGT", "TGCA")


def reverse_complement(seq: Column) -> Column:
    return complement(F.reverse(seq))


def strict_reverse_complement(seq: Column) -> Column:
    """Keeps case; a letter other than A, C, G, T, N is an error."""
    ok = F.coalesce(seq.rlike("^[ACGTNacgtn]*$"), F.lit(True))
    return F.when(ok, F.translate(F.reverse(seq), "ACGTacgt", "TGCAtgca")).otherwise(F.raise_error(F.concat(F.lit("not a base sequence: "), F.substring(seq, 1, 50))))


def normalized(seq: Column) -> Column:
    """N and n become A."""
    return F.translate(seq, "Nn", "AA")


def between(seq: Column, start: Column, end: Column) -> Column:
    """seq[start, end), null where that isn't within seq."""
    inside = (start >= 0) & (end >= start) & (end <= F.length(seq))
    return F.when(inside, F.substring(seq, (start + 1).cast("int"), (end - start).cast("int")))


def extracted(seq: Column, start: Column, end: Column, strand: Column, clip: bool = False) -> Column:
    """seq[start, end), reverse complemented on the minus strand. An end past the sequence is an error, or clipped."""
    end = F.least(end, F.length(seq)) if clip else end
    got = between(seq, start, end)
    got = got if clip else F.when(end > F.length(seq), F.raise_error(F.lit("the interval ends past its sequence"))).otherwise(got)
    return F.when(strand == "-", strict_reverse_complement(got)).otherwise(got)


def site_start(pos: Column, strand: Column, site: Column) -> Column:
    """Where the two bases of a splice site begin: at pos for plus donors and minus acceptors, else one before."""
    return F.when(((site == "D") & (strand == "+")) | ((site == "A") & (strand == "-")), pos).otherwise(pos - 1)


def site_motif(seq: Column, pos: Column, strand: Column, site: Column) -> Column:
    """The two bases of a splice site, reverse complemented on the minus strand; null where they aren't within seq."""
    start = site_start(pos, strand, site)
    pair = between(seq, start, start + 2)
    return F.when(strand == "-", reverse_complement(pair)).otherwise(F.upper(pair))


def site_key(chrom: Column, pos: Column, strand: Column) -> Column:
    return F.concat(chrom, F.lit(":"), pos.cast("string"), F.lit("("), strand, F.lit(")"))


def parsed_site_key(key: Column) -> Column:
    """Struct of chrom, pos and strand; nulls where the key isn't one. The chrom may hold colons and brackets."""
    part = lambda k: F.regexp_extract(key, r"^(.*):(\d+)\(([+-])\)$", k)
    ok = key.rlike(r"^.*:\d+\([+-]\)$")
    return F.struct(F.when(ok, part(1)).alias("chrom"), F.when(ok, part(2)).try_cast("bigint").alias("pos"), F.when(ok, part(3)).alias("strand"))


def region_header(chrom: Column, start: Column, end: Column, strand: Column) -> Column:
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"), F.lit("("), strand, F.lit(")"))


def parsed_region_header(header: Column) -> Column:
    """Struct of chrom, start, end and strand of `chrom:start-end(strand)`; nulls where it isn't one."""
    pattern = r"^(.+):(\d+)-(\d+)\(([+-])\)$"
    part = lambda k: F.when(header.rlike(pattern), F.regexp_extract(header, pattern, k))
    return F.struct(part(1).alias("chrom"), part(2).try_cast("bigint").alias("start"), part(3).try_cast("bigint").alias("end"), part(4).alias("strand"))


def parsed_scored_site(line: Column) -> Column:
    """Struct of chrom, pos, strand, site, score (float) and motif of `key, site, score, motif`, tab separated; null unless it has four fields that parse."""
    fields = F.split(line, "\t")
    key = parsed_site_key(F.get(fields, F.lit(0)))
    score = F.get(fields, F.lit(2)).try_cast("float")
    site = F.upper(F.get(fields, F.lit(1)))
    ok = (F.size(fields) == 4) & key["pos"].isNotNull() & score.isNotNull() & site.isin("D", "A")
    return F.when(ok, F.struct(key["chrom"].alias("chrom"), key["pos"].alias("pos"), key["strand"].alias("strand"), site.alias("site"), score.alias("score"), F.upper(F.get(fields, F.lit(3))).alias("motif")))


def padded(seq: Column, flank: int = 5000) -> Column:
    """`flank` N on each side."""
    return F.concat(F.repeat(F.lit("N"), F.lit(flank)), seq, F.repeat(F.lit("N"), F.lit(flank)))


def logit(x: Column) -> Column:
    return F.ln(x / (1 - x))


def rounded_half_even(x: Column, digits: int) -> Column:
    """Ties to even; for floats widened to doubles this is rounding of the exact binary value."""
    return F.bround(x.cast("double"), digits)


def file_safe(name: Column) -> Column:
    """Letters, digits, dot, underscore and hyphen stay, others become underscores; an empty name is `unknown`."""
    return F.coalesce(F.nullif(F.regexp_replace(name, "[^A-Za-z0-9._-]", "_"), F.lit("")), F.lit("unknown"))
