"""Names of inputs and outputs, checked on the driver before any plan is made."""

from __future__ import annotations

import io
import re
import shutil
import sys
from pathlib import Path, PurePosixPath
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession

from . import files
from .binary import register, sniff
from .named_files import names_in
from .text import read_fasta

SITES, STRANDS = ("donor", "acceptor"), ("plus", "minus")


class _After(io.RawIOBase):
    """A stream of which the head is read already."""

    def __init__(self, head: bytes, rest) -> None:
        self.head, self.rest = head, rest

    def read(self, n: int = -1) -> bytes:
        head, self.head = self.head, b""
        return head or self.rest.read(n)


def genome_kind(path: str) -> str:
    """2bit or fasta by extension; .gz is FASTA."""
    end = path.rsplit(".", 1)[-1].lower()
    if end == "2bit":
        return "2bit"
    if end in ("fa", "fasta", "fna", "gz"):
        return "fasta"
    raise ValueError(f"{path} has the ending of neither FASTA nor 2bit")


def read_genome(spark: SparkSession, path: str, mode: str = "lenient", stream: BinaryIO | None = None) -> DataFrame:
    """chrom and seq of a FASTA or 2bit file; `-` is a stream (standard input), kept in the shared folder, told by its first bytes."""
    if path == "-":
        stream = stream or sys.stdin.buffer
        head = stream.read(1 << 16)
        if not head:
            raise ValueError("standard input is empty")
        name = {"gzip": "input.fa.gz", "2bit": "input.2bit", "fasta": "input.fa"}[sniff(head)]
        path = files.keep_stream(spark, _After(head, stream), f"{files.work_folder(spark)}/{name}")
    if genome_kind(path) == "2bit":
        register(spark)
        return spark.read.format("twobit").option("path", path).load()
    return read_fasta(spark, path, mode)


def classify_track(stem: str) -> tuple[str, str] | None:
    """(site, strand) that a file name tells; None if it tells neither, an error if it tells one only or both of a kind."""
    name = re.sub("[^a-z0-9]", "", stem.lower())
    sites, strands = [s for s in SITES if s in name], [s for s in STRANDS if s in name]
    if not sites and not strands:
        return None
    for kinds, found in ((SITES, sites), (STRANDS, strands)):
        if len(found) != 1:
            raise ValueError(f"{stem} names {'none' if not found else 'both'} of {' and '.join(kinds)}")
    return sites[0], strands[0]


def discover_tracks(folder: str) -> dict[tuple[str, str], str]:
    """The BigWig file of each site and strand in a folder; each must be there once."""
    names = names_in(folder)
    if names is None:
        raise ValueError(f"{folder} isn't a folder of tracks")
    found: dict[tuple[str, str], list[str]] = {}
    for p in map(PurePosixPath, names):
        if p.suffix.lower() in (".bw", ".bigwig") and (kind := classify_track(p.stem)):
            found.setdefault(kind, []).append(f"{folder.rstrip('/')}/{p}")
    for kind, paths in found.items():
        if len(paths) > 1:
            raise ValueError(f"{len(paths)} files tell {' '.join(kind)}: {', '.join(sorted(paths))}")
    if lacking := [f"{s} {t}" for s in SITES for t in STRANDS if (s, t) not in found]:
        raise ValueError(f"no file tells {', '.join(lacking)}")
    return {kind: paths[0] for kind, paths in found.items()}


def output_stem(path: str) -> str:
    """A file's name without .gz and a FASTA ending, or else without its last ending."""
    name = Path(path).name.removesuffix(".gz")
    for end in (".fasta", ".fa", ".fna", ".fas"):
        if name.endswith(end):
            return name.removesuffix(end)
    return Path(name).stem


def chunk_folder(out: str) -> str:
    """`chunks` in `out` if that is a folder, else beside it."""
    return f"{out if Path(out).is_dir() else str(Path(out).parent)}/chunks"


def single_file(out: str, gz: bool) -> str:
    """`out`, with .gz added once if compressed; a folder is an error."""
    if Path(out).is_dir():
        raise ValueError(f"a single file can't be written to the folder {out}")
    return out if not gz or out.endswith(".gz") else f"{out}.gz"


def chunk_name(prefix: str, index: int, gz: bool = False) -> str:
    return f"{prefix}.{index:05d}.tsv{'.gz' if gz else ''}"


def check_number(name: str, value: float, least: float = 0, most: float | None = None, strictly: bool = False) -> None:
    if value < least or (strictly and value == least) or (most is not None and value > most):
        raise ValueError(f"{name} is {value}")


def aligner_there(program: str) -> bool:
    return shutil.which(program) is not None
