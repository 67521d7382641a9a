"""Text formats: junction tables, FASTA, annotations, windows, chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import checkpointed, small
from . import block_gzip, files
from .named_files import read_named

_JUNCTION = ("chr", "start", "end", "strand", "motif", "annotated", "coverage", "multimap", "overhang")


def read_junctions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Splice-junction tables with file_ord (by the order of `paths`) and line order `at`.

    Fields are split at any white space. Lines of fewer than 8 fields are skipped; 8, or more than 9, are an error.
    start and end stay text; numbers that don't parse are an error.
    """
    rows = None
    for k, path in enumerate(paths):
        one = spark.read.text(path).select("value", F.lit(k).alias("file_ord"), F.monotonically_increasing_id().alias("at"))
        rows = one if rows is None else rows.unionAll(one)
    if rows is None:
        raise ValueError("no junction files")
    fields = rows.select(F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ").alias("f"), "file_ord", "at").filter(F.size("f") >= 8)
    nine = F.when(F.size("f") == 9, F.col("f")).otherwise(F.raise_error(F.lit("a junction has 9 fields")).cast("array<string>"))
    named = fields.select(nine.alias("f"), "file_ord", "at")
    kinds = {"annotated": "int", "coverage": "bigint", "multimap": "bigint", "overhang": "bigint"}
    return named.select(*[F.col("f")[k].cast(kinds.get(c, "string")).alias(c) for k, c in enumerate(_JUNCTION)], "file_ord", "at")


def read_fasta(spark: SparkSession, path: str, mode: str = "lenient", task_bytes: int = block_gzip.TASK_BYTES) -> DataFrame:
    """chrom (the whole header line) and seq of FASTA files; gzip by name, or of a single file by its first bytes.

    lenient: white space at line ends is dropped, a repeated header's last record holds, and letters before a file's
    first header begin its first record. strict: headers are trimmed and must be non-empty, space or tab within a
    sequence is an error. predict: lines are stripped at both ends. In these two a file must begin with a header.
    Records are split by the text source, so a file of many records is read in parallel unless it is compressed; a single
    block gzip file is, too, in ranges of `task_bytes`.
    """
    if mode not in ("lenient", "strict", "predict"):
        raise ValueError(f"no such mode: {mode}")
    head = files.head_of(spark, path)
    if head and block_gzip.member_size(head):
        head = files.unpacked(head)
        raw = block_gzip.read_records(spark, path, "\n>", task_bytes).select("value", F.lit(path).alias("_file"), F.col("at").alias("_at"))
    else:
        if head and head[:2] == files.GZIP:
            path, head = files.named_gz(spark, path), files.unpacked(head)
        raw = spark.read.option("lineSep", "\n>").text(path).withColumn("_file", F.col("_metadata.file_path")).withColumn("_at", F.monotonically_increasing_id())
    first = raw.groupBy("_file").agg(F.min("_at").alias("_first"))
    return _fasta(raw.join(small(checkpointed(first)), "_file"), mode, head is None or head.strip()[:1] not in (b">", b""))


def read_fasta_files(names: DataFrame, folder: str, mode: str = "lenient") -> DataFrame:
    """As read_fasta, of the files of `folder` that `names` has (file; see sinks.chunk_fasta), which are opened by tasks; the driver lists none.

    Of a header in more files than one, the last record of the last file by name holds.
    """
    if mode not in ("lenient", "strict", "predict"):
        raise ValueError(f"no such mode: {mode}")
    place = lambda k: F.struct(F.col("file").alias("f"), k.alias("k"))
    return _fasta(read_named(names, folder, "\n>").select("value", F.col("file").alias("_file"), place(F.col("at")).alias("_at"), place(F.lit(0).cast("long")).alias("_first")), mode)


def _fasta(raw: DataFrame, mode: str, may_lead: bool = True) -> DataFrame:
    """chrom and seq of records (value) with their file, place, and the place of the file's first; may_lead: letters may be before a first header."""
    # the first record of a file still has its `>`
    rows = raw.filter(F.length(F.trim("value")) > 0)
    is_first, has_mark = F.col("_at") == F.col("_first"), F.col("value").startswith(">")
    if mode == "lenient" and may_lead:
        # a file's first record may be letters only: the next one gets them
        lead = rows.filter(is_first & ~has_mark).select("_file", F.col("value").alias("_lead"))
        second = rows.join(lead.select("_file"), "_file", "left_semi").filter(~is_first).groupBy("_file").agg(F.min("_at").alias("_second"))
        leads = checkpointed(lead.join(second, "_file").select(F.col("_file").alias("_of"), "_second", "_lead"))
        rows = rows.filter(~is_first | has_mark)
        if not leads.isEmpty():
            rows = rows.join(leads, (F.col("_file") == F.col("_of")) & (F.col("_at") == F.col("_second")), "left")
            joined = F.concat(F.substring_index("value", "\n", 1), F.lit("\n"), "_lead", F.substring("value", F.length(F.substring_index("value", "\n", 1)) + 1, F.length("value")))
            rows = rows.withColumn("value", F.coalesce(joined, F.col("value")))
    begins = F.col("value").startswith(">")
    record = F.when((F.col("_at") == F.col("_first")) & ~begins, F.raise_error(F.lit("the file doesn't begin with a header"))).when((F.col("_at") == F.col("_first")) & F.col("value").startswith(">"), F.substring("value", 2, 2_000_000_000)).otherwise(F.col("value"))
    rows = rows.select(F.regexp_replace(record, "\r", "").alias("r"), "_at")
    header, body = F.substring_index("r", "\n", 1), F.when(F.instr("r", "\n") > 0, F.substring("r", F.instr("r", "\n") + 1, F.length("r"))).otherwise(F.lit(""))
    if mode == "strict":
        header = F.when(F.trim(header) == "", F.raise_error(F.lit("an empty header"))).otherwise(F.trim(header))
        body = F.when(body.rlike("[ \t]"), F.raise_error(F.lit("white space within a sequence"))).otherwise(body)
    elif mode == "predict":
        header = F.rtrim(header)
        body = F.regexp_replace(body, r"(?m)^[ \t]+|[ \t]+$", "")
    named = rows.select(header.alias("chrom"), F.replace(body, F.lit("\n"), F.lit("")).alias("seq"), "_at")
    return named.groupBy("chrom").agg(F.max_by("seq", "_at").alias("seq"))


def _exons(starts: Column, sizes: Column, offset: Column) -> Column:
    numbers = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("bigint"))
    return F.zip_with(numbers(starts), numbers(sizes), lambda a, n: F.struct((offset + a).alias("start"), (offset + a + n).alias("end")))


def read_bed12(spark: SparkSession, path: str) -> DataFrame:
    """Transcripts: chrom, tx_start, tx_end, name, strand, thick_start, thick_end, exons."""
    rows = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(#|track|browser|$)")).select(F.split("value", "\t").alias("f"))
    ok = F.when(F.size("f") >= 12, F.col("f")).otherwise(F.raise_error(F.lit("a BED12 line has 12 fields")).cast("array<string>"))
    rows = rows.select(ok.alias("f"))
    n = lambda k: F.col("f")[k].cast("bigint")
    return rows.select(F.col("f")[0].alias("chrom"), n(1).alias("tx_start"), n(2).alias("tx_end"), F.col("f")[3].alias("name"), F.col("f")[5].alias("strand"), n(6).alias("thick_start"), n(7).alias("thick_end"), _exons(F.col("f")[11], F.col("f")[10], n(1)).alias("exons"))


def read_gene_models(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Transcripts of a GTF (kind `gtf`) or GFF (`gff`) file in the form of read_bed12: exons by transcript, in order; thick parts from CDS rows."""
    rows = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(#|$)")).select(F.split("value", "\t").alias("f")).filter(F.size("f") == 9)
    pattern = r'transcript_id "([^"]*)"' if kind == "gtf" else r"(?:^|;)\s*Parent=([^;,]*)"
    rows = rows.select(F.col("f")[0].alias("chrom"), F.col("f")[2].alias("kind"), (F.col("f")[3].cast("bigint") - 1).alias("start"), F.col("f")[4].cast("bigint").alias("end"), F.col("f")[6].alias("strand"), F.regexp_extract(F.col("f")[8], pattern, 1).alias("name"))
    parts = rows.filter(F.col("kind").isin("exon", "CDS") & (F.col("name") != ""))
    exon, coding = F.col("kind") == "exon", F.col("kind") == "CDS"
    made = parts.groupBy("chrom", "name", "strand").agg(
        F.min("start").alias("tx_start"), F.max("end").alias("tx_end"), F.min(F.when(coding, F.col("start"))).alias("a"), F.max(F.when(coding, F.col("end"))).alias("b"), F.array_sort(F.collect_list(F.when(exon, F.struct("start", "end")))).alias("exons")
    )
    return made.select("chrom", "tx_start", "tx_end", "name", "strand", F.coalesce("a", "tx_end").alias("thick_start"), F.coalesce("b", "tx_end").alias("thick_end"), "exons")


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """By extension: .bed, .gtf or .gff, also with .gz; anything else is an error."""
    kind = path.removesuffix(".gz").rsplit(".", 1)[-1].lower()
    if kind == "bed":
        return read_bed12(spark, path)
    if kind in ("gtf", "gff"):
        return read_gene_models(spark, path, kind)
    raise ValueError(f"unsupported annotation: {path}")


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, start long, end long, strand string, seq string")


def read_chains(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """chains and blocks (see operators.chains) of chain files; a target strand other than plus is an error.

    A chain is what a header line begins, whether or not an empty line is before it.
    """
    raw = spark.read.option("lineSep", "\nchain ").text(path).select(F.regexp_replace("value", r"\A(#[^\n]*\n|\s)*(chain )?", "").alias("v")).filter(F.col("v").rlike(r"\S"))
    lines = F.filter(F.split("v", r"\r?\n"), lambda x: ~x.rlike(r"^\s*(#.*)?$"))
    h = raw.select(lines.alias("l")).filter(F.size("l") > 0).select(F.split(F.trim(F.get("l", F.lit(0))), r"\s+").alias("h"), F.slice("l", F.lit(2), F.size("l")).alias("b")).filter("h is not null")
    n = lambda k: F.get("h", F.lit(k)).cast("bigint")
    target = F.when(F.get("h", F.lit(3)) == "+", F.get("h", F.lit(3))).otherwise(F.raise_error(F.lit("the target strand isn't plus")))
    chains = h.select(n(11).alias("chain_id"), n(0).alias("score"), F.get("h", F.lit(1)).alias("t_name"), n(2).alias("t_size"), target.alias("t_strand"), n(4).alias("t_start"), n(5).alias("t_end"), F.get("h", F.lit(6)).alias("q_name"), n(7).alias("q_size"), F.get("h", F.lit(8)).alias("q_strand"), n(9).alias("q_start"), n(10).alias("q_end"))
    blocks = h.select(n(11).alias("chain_id"), F.posexplode("b").alias("block_no", "line")).withColumn("x", F.split(F.trim("line"), r"\s+"))
    return chains, blocks.select("chain_id", "block_no", F.get("x", F.lit(0)).cast("bigint").alias("size"), F.get("x", F.lit(1)).cast("bigint").alias("dt"), F.get("x", F.lit(2)).cast("bigint").alias("dq"))


def read_mini_chains(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Gaps and patches of an aligner's stream: for each gap a line `LINE<n>`, five numbers, chains, and the same line again.

    gaps: line (n), size, t_block_end, t_gap_end, q_block_end, q_gap_end. patches: line, rank (from 0, in order of the
    stream), score, t_start, t_end, q_strand, q_size, q_start, q_end and blocks (array of size, dt, dq); positions are
    as in the chain's header. A gap without an alignment has no patch. A block that doesn't end with its line is an error.
    """
    raw = spark.read.option("lineSep", "LINE").text(path).select(F.regexp_extract("value", r"\A(\d+)", 1).alias("n"), F.regexp_replace("value", r"\A\d+\s*", "").alias("rest"), F.monotonically_increasing_id().alias("at")).filter("n <> ''")
    whole = raw.groupBy(F.col("n").cast("bigint").alias("line")).agg(F.count(F.lit(1)).alias("times"), F.min_by("rest", "at").alias("rest"))
    lines = F.filter(F.split("rest", r"\r?\n"), lambda x: F.trim(x) != "")
    checked = F.when(F.col("times") == 2, lines).otherwise(F.raise_error(F.concat(F.lit("a block isn't closed: LINE"), F.col("line").cast("string"))).cast("array<string>"))
    rows = whole.select("line", checked.alias("l"))
    n = lambda k: F.trim(F.get("l", F.lit(k))).cast("bigint")
    gaps = rows.select("line", *[n(k).alias(c) for k, c in enumerate(("size", "t_block_end", "t_gap_end", "q_block_end", "q_gap_end"))])
    chains = F.split(F.array_join(F.slice("l", F.lit(6), F.size("l")), "\n"), r"(?m)^chain ")
    found = rows.select("line", F.posexplode(F.filter(chains, lambda x: F.trim(x) != "")).alias("rank", "c")).select("line", "rank", F.split("c", "\n").alias("c"))
    found = found.select("line", "rank", F.split(F.trim(F.get("c", F.lit(0))), r"\s+").alias("h"), F.filter(F.slice("c", F.lit(2), F.size("c")), lambda x: x.rlike(r"^\d")).alias("b"))
    h = lambda k: F.get("h", F.lit(k))
    cell = lambda x, k: F.get(F.split(F.trim(x), r"\s+"), F.lit(k)).cast("bigint")
    blocks = F.transform("b", lambda x: F.struct(cell(x, 0).alias("size"), cell(x, 1).alias("dt"), cell(x, 2).alias("dq")))
    numbers = [h(k).cast("bigint").alias(c) for k, c in ((0, "score"), (4, "t_start"), (5, "t_end"), (7, "q_size"), (9, "q_start"), (10, "q_end"))]
    return gaps, found.select("line", "rank", *numbers, h(8).alias("q_strand"), blocks.alias("blocks"))
