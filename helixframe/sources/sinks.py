"""Outputs with fixed names and layouts. Files are written by executors, where all machines reach them (see named_files)."""

from __future__ import annotations

import itertools
import struct
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import file_safe, region_header, site_key
from ..operators.ordering import in_order
from ..storage import checkpointed, small
from . import binary, block_gzip
from .named_files import write_files, write_named
from .paths import chunk_name


def lines_of(rows: DataFrame, columns: list[str], order: list, sep: str = "\t") -> DataFrame:
    """value: the columns of each row, in `order` across the whole output."""
    return rows.orderBy(*order).select(F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value"))


def write_tsv(rows: DataFrame, path: str, columns: list[str], order: list) -> None:
    """A folder of text files that are in order when read by name."""
    lines_of(rows, columns, order).write.mode("overwrite").text(path)


def junction_lines(merged: DataFrame) -> DataFrame:
    """Merged junctions in order of first appearance, with a literal 1 for annotated."""
    rows = merged.withColumn("annotated", F.lit(1))
    return lines_of(rows, ["chr", "start", "end", "strand", "motif", "annotated", "coverage", "multimap", "overhang"], ["first"])


def derived_lines(derived: DataFrame) -> DataFrame:
    from ..operators.calibration import output_order

    return lines_of(derived, ["chrom", "coordinate", "strand", "site", "derived_score"], output_order())


def size_lines(genome: DataFrame) -> DataFrame:
    """chrom and size of each sequence."""
    return lines_of(genome.select("chrom", F.length("seq").alias("size")), ["chrom", "size"], ["chrom"])


def site_lines(sites: DataFrame, strand: str) -> DataFrame:
    """Scored sites of a strand as key, site, score and motif."""
    rows = sites.filter(F.col("strand") == strand).withColumn("key", site_key(F.col("chrom"), F.col("pos"), F.col("strand")))
    return lines_of(rows, ["key", "site", "score", "motif"], ["chrom", "pos", "site"])


def numbered_patch_lines(patches: DataFrame, first: int = 0) -> DataFrame:
    """A header line for each patch, by chain, block and rank, ending in its number from `first` on."""
    placed = in_order(patches, ["chain_id", "block_no", "rank"], "_k")
    return lines_of(placed.withColumn("number", F.col("_k") + first), ["score", "t_start", "t_end", "q_start", "q_end", "number"], ["number"])


def _write(groups: DataFrame, by: str, folder: str, gz: bool, write: Callable = write_named):
    """The lines (file, ord, value) of each file, in ranges of the order, joined; what `write` gives, names of the files."""
    ranged = groups.repartitionByRange(by, "ord").sortWithinPartitions(by, "ord")
    return write(ranged.select(F.col(by).alias("file"), F.concat("value", F.lit("\n")).alias("value")), folder, gz)


def write_rotating(rows: DataFrame, folder: str, prefix: str, columns: list[str], order: list, most: int, gz: bool = False) -> list[str]:
    """Tab-separated files of `most` rows each, numbered from 1; no rows give no file."""
    numbered = in_order(rows, order, "_k").withColumn("_file", (F.floor(F.col("_k") / most) + 1).cast("int"))
    name = F.concat(F.lit(f"{prefix}."), F.lpad(F.col("_file").cast("string"), 5, "0"), F.lit(chunk_name("", 0, gz).removeprefix(".00000")))
    return _write(numbered.select(name.alias("file"), F.col("_k").alias("ord"), F.concat_ws("\t", *[F.col(c).cast("string") for c in columns]).alias("value")), "file", folder, gz)


def write_chunk_fasta(chunks: DataFrame, folder: str, gz: bool = False) -> list[str]:
    """As chunk_fasta, where the files are few; their names."""
    return sorted(r.file for r in chunk_fasta(chunks, folder, gz).collect())


def chunk_fasta(chunks: DataFrame, folder: str, gz: bool = False) -> DataFrame:
    """tmp.<chrom>.chunk.<i>.fa files with a record for each strand, and their names (file); chroms that would have one file name are an error."""
    safe = chunks.select("chrom").distinct().groupBy(file_safe(F.col("chrom")).alias("s")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if clash := [r.s for r in safe.take(3)]:
        raise ValueError(f"chroms with the same file name: {clash}")
    name = F.concat(F.lit("tmp."), file_safe(F.col("chrom")), F.lit(".chunk."), F.col("chunk_index").cast("string"), F.lit(".fa.gz" if gz else ".fa"))
    header = F.concat(F.lit(">"), region_header(F.col("chrom"), F.col("start"), F.col("end"), F.col("strand")))
    rows = chunks.select(name.alias("file"), (F.col("strand") != "+").cast("int").alias("ord"), F.concat(header, F.lit("\n"), F.col("seq")).alias("value"))
    return _write(rows, "file", folder, gz, write_files)


def wig_lines(scored: DataFrame, column: str, least: float = 0.001, digits: int = 4) -> DataFrame:
    """file, ord (chrom and start) and value (a fixedStep block) of each record's values; blocks begin two after the chunk's start.

    scored: chrom, start, strand and `column` (an array). Numbers are written as Python writes them.
    """
    site = F.when(F.col("strand") == "-", f"{column}_minus").otherwise(f"{column}_plus")

    def text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = ["\n".join([f"fixedStep chrom={c} start={s + 2} step=1", *(repr(round(float(x), digits)) if x >= least else "0.0" for x in v)]) for c, s, v in zip(b["chrom"], b["start"], b["values"], strict=True)]
            yield pd.DataFrame({"file": b["file"], "chrom": b["chrom"], "start": b["start"], "value": made})

    rows = scored.select(F.concat(site, F.lit(".wig")).alias("file"), "chrom", F.col("start").cast("long"), F.col(column).alias("values"))
    return rows.mapInPandas(text, "file string, chrom string, start long, value string").select("file", F.struct("chrom", "start").alias("ord"), "value")


def write_wig(scored: DataFrame, folder: str, prefix: str, least: float = 0.001, digits: int = 4) -> list[str]:
    """Four files, <prefix>.{acceptor,donor}_{plus,minus}.wig, each there even if empty; blocks are written in ranges of chrom and start."""
    both = wig_lines(scored, "acceptor", least, digits).unionAll(wig_lines(scored, "donor", least, digits))
    made = _write(both.withColumn("file", F.concat(F.lit(f"{prefix}."), "file")), "file", folder, False)
    names = [f"{prefix}.{kind}_{strand}.wig" for kind in ("acceptor", "donor") for strand in ("plus", "minus")]
    if empty := [(n, "") for n in names if n not in made]:
        write_named(scored.sparkSession.createDataFrame(empty, "file string, value string"), folder)
    return sorted(names)


def _kept(parts: DataFrame) -> DataFrame:
    """`parts` of a file, written to the shared folder, with their partition (_p) and place in it (_k)."""
    return checkpointed(parts.withColumn("_p", F.spark_partition_id()).withColumn("_k", F.monotonically_increasing_id()))


def _before(kept: DataFrame, sizes: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """What parts before each one come to (`sizes`: name and column), and what all do. Partitions' totals alone are put together."""
    totals = checkpointed(kept.groupBy("_p").agg(*[F.sum(c).cast("bigint").alias(f"_{n}") for n, c in sizes.items()]))
    along, within = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_p").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("_p").alias("_q"), *[F.coalesce(F.sum(f"_{n}").over(along), F.lit(0)).alias(f"_{n}") for n in sizes])
    rows = kept.select("*", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(n) for n, c in sizes.items()]).join(small(checkpointed(starts)), F.col("_p") == F.col("_q"))
    whole = totals.agg(*[F.coalesce(F.sum(f"_{n}"), F.lit(0)).alias(n) for n in sizes]).first().asDict()
    return rows.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sizes}).drop("_q", *[f"_{n}" for n in sizes]), whole


def _values(rows: DataFrame, value: Callable[..., bytes], *columns: str) -> DataFrame:
    """value: bytes of each row's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([pa.array([value(*r) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)], pa.binary())], names=["value"])

    return rows.select(*columns).mapInArrow(run, "value binary")


def _one_file(folder: str, name: str, *parts: DataFrame | bytes) -> str:
    """A file of these bytes and rows (value), as they are dealt and ordered; its path."""
    spark = next(p for p in parts if isinstance(p, DataFrame)).sparkSession
    rows = [spark.createDataFrame([(bytearray(p),)], "value binary").coalesce(1) if isinstance(p, bytes) else p.select("value") for p in parts]
    write_named(reduce(DataFrame.unionAll, rows).select(F.lit(name).alias("file"), "value"), folder)
    return f"{folder}/{name}"


def write_twobit(genome: DataFrame, folder: str, name: str = "genome.2bit") -> str:
    """A 2bit file of chrom and seq; its path. Sequences are packed where they are, and no task has more than one at a time in bytes.

    From 4 GB on, the file is of version 1, whose index has places of 64 bits; smaller ones are of version 0.
    """
    body = _values(genome, lambda chrom, seq: struct.pack("<H", len(chrom.encode())) + chrom.encode() + binary.twobit_body(seq), "chrom", "seq")
    kept = _kept(body)
    n = F.conv(F.hex(F.concat(F.substring("value", 2, 1), F.substring("value", 1, 1))), 16, 10).cast("int")
    kept = kept.select("_p", "_k", "value", n.alias("_n"), F.octet_length("value").alias("_bytes"))
    slim = kept.select("_p", "_k", F.substring(F.col("value"), F.lit(3), F.col("_n")).alias("name"), (F.col("_bytes") - 2 - F.col("_n")).alias("_bytes"))
    placed, whole = _before(slim, {"at": F.col("_bytes"), "index": F.octet_length("name") + 5, "n": F.lit(1)})
    first = 16 + whole["index"]
    long = first + whole["at"] >= binary.TWOBIT_BYTES
    first += 4 * whole["n"] * long
    index = placed.withColumn("at", F.col("at") + first).repartitionByRange("_p", "_k").sortWithinPartitions("_p", "_k")
    bodies = kept.select(F.substring(F.col("value"), F.col("_n") + 3, F.col("_bytes")).alias("value"))
    return _one_file(folder, name, binary.twobit_head(whole["n"], long), _values(index, partial(binary.twobit_entry, long=long), "name", "at"), bodies)


#: Contigs of a BigWig file, and leaf nodes of its index: what a node may have.
NODE_MOST = (1 << 16) - 1


def write_bigwig(values: DataFrame, folder: str, name: str = "track.bw", per_section: int = 1024, per_node: int = 1024) -> str:
    """A BigWig file of chrom, pos and score, one base each; its path. Values are put in order by ranges, and sections are packed where those are."""
    contigs = [(r.chrom, r.size) for r in values.groupBy("chrom").agg((F.max("pos") + 1).alias("size")).limit(NODE_MOST + 1).collect()]
    if len(contigs) > NODE_MOST:
        raise ValueError(f"more than {NODE_MOST} contigs")
    contigs.sort()
    numbers = {c: k for k, (c, _) in enumerate(contigs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["value", "c", "p0", "p1"]
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        held: tuple[np.ndarray, ...] = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32))

        def sections(c: np.ndarray, pos: np.ndarray, score: np.ndarray, end: bool) -> tuple[list[tuple], int]:
            made, at = [], 0
            while at < len(c):
                last = min(int(np.searchsorted(c, c[at], "right")), at + per_section)
                if last == len(c) and last - at < per_section and not end:
                    break  # it may go on
                made.append((binary.bigwig_section(int(c[at]), pos[at:last], score[at:last]), int(c[at]), int(pos[at]), int(pos[last - 1]) + 1))
                at = last
            return made, at

        for b in itertools.chain(batches, [None]):
            if b is not None:
                new = np.array([numbers[x] for x in b.column(0).to_pylist()], np.int64), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
                held = tuple(np.concatenate(x) for x in zip(held, new, strict=True))
            made, at = sections(*held, b is None)
            held = tuple(x[at:] for x in held)
            yield pa.record_batch([pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)], names=names)

    ranged = values.select("chrom", F.col("pos").cast("long"), F.col("score").cast("float")).repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos")
    kept = _kept(ranged.mapInArrow(run, "value binary, c long, p0 long, p1 long"))
    slim = kept.select("_p", "_k", "c", "p0", "p1", F.octet_length("value").alias("_bytes"))
    placed, whole = _before(slim, {"at": F.col("_bytes"), "n": F.lit(1)})
    head = binary.bigwig_head(contigs, whole["at"])
    grouped = placed.withColumn("node", F.floor(F.col("n") / per_node)).withColumn("at", F.col("at") + len(head))
    leaf = F.sort_array(F.collect_list(F.struct("n", "c", "p0", "p1", "at", "_bytes"))).alias("items")
    nodes = checkpointed(grouped.groupBy("node").agg(leaf))
    bounds = nodes.select("node", F.get("items", F.lit(0)).alias("a"), F.element_at("items", -1).alias("z"), F.size("items").alias("n")).select("node", F.col("a.c").alias("c0"), F.col("a.p0").alias("p0"), F.col("z.c").alias("c1"), F.col("z.p1").alias("p1"), "n")
    if whole["n"] > per_node * NODE_MOST:
        raise ValueError(f"more than {NODE_MOST} nodes of the index")
    root = binary.bigwig_root([r[1:] for r in sorted(map(tuple, bounds.collect()))], whole["n"], len(head) + whole["at"])
    packed = lambda items: struct.pack("<BBH", 1, 0, len(items)) + b"".join(struct.pack("<IIIIQQ", i["c"], i["p0"], i["c"], i["p1"], i["at"], i["_bytes"]) for i in items)
    leaves = _values(nodes.repartitionByRange("node").sortWithinPartitions("node"), packed, "items")
    return _one_file(folder, name, head, kept, root, leaves)


def write_block_gzip(lines: DataFrame, folder: str, name: str, size: int = 60_000) -> str:
    """A block gzip file of the lines (value), as they are dealt and ordered; its path. Each task packs its own, a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = "".join(f"{v}\n" for v in b.column(0).to_pylist()).encode()
            yield pa.record_batch([pa.array([block_gzip.members(text, size)], pa.binary())], names=["value"])

    return _one_file(folder, name, lines.select("value").mapInArrow(run, "value binary"), block_gzip.END)


def peak_lines(lines: DataFrame, mode: str = "bedgraph") -> DataFrame:
    """bedGraph (4 columns) or BED6 lines of profile_lines."""
    columns = {"bedgraph": ["chrom", "line_start", "line_end", "value"], "bed": ["chrom", "line_start", "line_end", "name", "value", "strand"]}[mode]
    return lines_of(lines, columns, ["chrom", "line_start", "strand"])


def chain_lines(chains: DataFrame, blocks: DataFrame) -> DataFrame:
    """value: the text of each chain, with an empty line after it, in order of chain_id. blocks may have parts."""
    part = F.col("part") if "part" in blocks.columns else F.lit(0)
    line = F.struct("block_no", part.alias("part"), F.concat_ws("\t", F.col("size").cast("string"), F.col("dt").cast("string"), F.col("dq").cast("string")).alias("t"))
    body = blocks.groupBy("chain_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["t"]), "\n").alias("body"))
    head = F.concat_ws(" ", F.lit("chain"), *[F.col(c).cast("string") for c in ("score", "t_name", "t_size", "t_strand", "t_start", "t_end", "q_name", "q_size", "q_strand", "q_start", "q_end", "chain_id")])
    return chains.join(body, "chain_id").orderBy("chain_id").select(F.concat(head, F.lit("\n"), "body", F.lit("\n")).alias("value"))
