"""Files by path on any file system that Spark knows, from the driver: first bytes, copies, and what comes from standard input."""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

from pyspark.sql import SparkSession

from ..storage import shared_folder

GZIP = b"\x1f\x8b"


def _at(spark: SparkSession, path: str):
    """(path, its file system) as the JVM has them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def parts(spark: SparkSession, folder: str) -> list[str]:
    """The files of a written folder, in order, without those that begin with a dot or an underscore."""
    p, fs = _at(spark, folder)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName()[0] not in "._")


def copied(spark: SparkSession, path: str, to: str) -> str:
    """A copy of a file; its path."""
    (p, fs), (q, other) = _at(spark, path), _at(spark, to)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, other, q, False, spark._jsc.hadoopConfiguration())
    return to


def head_of(spark: SparkSession, path: str, n: int = 1 << 16) -> bytes | None:
    """The first n bytes of a file, as stored; None if the path isn't one file."""
    if any(c in path for c in "*?[{"):
        return None
    p, fs = _at(spark, path)
    if not fs.exists(p) or not fs.getFileStatus(p).isFile():
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def unpacked(head: bytes) -> bytes:
    """What the first bytes of a gzip file begin with; other bytes as they are."""
    return zlib.decompressobj(31).decompress(head) if head[:2] == GZIP else head


def work_folder(spark: SparkSession) -> str:
    """A new folder's path in the shared one."""
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def named_gz(spark: SparkSession, path: str) -> str:
    """A path under which Spark unpacks a gzip file: its own, or a copy with .gz in the shared folder."""
    if path.endswith(".gz"):
        return path
    return copied(spark, path, f"{work_folder(spark)}/{path.rsplit('/', 1)[-1]}.gz")


def keep_stream(spark: SparkSession, stream: BinaryIO, to: str) -> str:
    """What a stream holds, written to a file in pieces of 4 MB; its path."""
    p, fs = _at(spark, to)
    out = fs.create(p)
    try:
        while piece := stream.read(1 << 22):
            out.write(bytearray(piece))
    finally:
        out.close()
    return to


class Joined(io.RawIOBase):
    """Files one after the other, as one stream."""

    def __init__(self, opened: Iterator[BinaryIO]) -> None:
        self.rest, self.now = opened, None

    def read(self, n: int = -1) -> bytes:
        while True:
            if self.now and (piece := self.now.read(n)):
                return piece
            self.now = next(self.rest, None)
            if self.now is None:
                return b""
