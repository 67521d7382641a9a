"""Block gzip (BGZF): gzip files of small members that tell their size, read from many places at once.

A task takes a range of the file's bytes: it looks for the first member that begins in it, and reads members up to the
range's end. Records belong to the range that has the first byte of the separator before them, and go on past its end.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .named_files import opened

#: Compressed bytes of a task, and the most that a member has.
TASK_BYTES, MEMBER_MOST = 8 << 20, 1 << 16
_MAGIC = b"\x1f\x8b\x08\x04"


def member_size(head: bytes) -> int | None:
    """The size of the member that begins here, if its header tells it."""
    if len(head) < 12 or head[:4] != _MAGIC:
        return None
    extra = head[12 : 12 + struct.unpack("<H", head[10:12])[0]]
    while len(extra) >= 4:
        (n,) = struct.unpack("<H", extra[2:4])
        if extra[:2] == b"BC" and n == 2 and len(extra) >= 6:
            return struct.unpack("<H", extra[4:6])[0] + 1
        extra = extra[4 + n :]
    return None


def unpacked_member(data: bytes) -> bytes:
    return zlib.decompress(data[12 + struct.unpack("<H", data[10:12])[0] : -8], -15)


def members(data: bytes, size: int = 60_000) -> bytes:
    """`data` as members of block gzip, `size` bytes each."""
    out = []
    for k in range(0, len(data), size):
        out.append(_member(data[k : k + size]))
    return b"".join(out)


def _member(part: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(part) + deflate.flush()
    return _MAGIC + b"\0\0\0\0\0\xff" + struct.pack("<HBBHH", 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))


#: The empty member that ends such files.
END = _member(b"")


def pack(data: bytes, size: int = 60_000) -> bytes:
    """`data` as block gzip, `size` bytes a member, with the empty member that ends such files."""
    return members(data, size) + END


class Range(InputPartition):
    def __init__(self, number: int, start: int, end: int) -> None:
        self.number, self.start, self.end = number, start, end


class BlockGzipReader(DataSourceReader):
    def __init__(self, path: str, separator: bytes, task_bytes: int) -> None:
        self.path, self.separator, self.task_bytes = path, separator, task_bytes

    def partitions(self) -> list[Range]:
        with opened(self.path) as f:
            size = f.size()
        return [Range(k, at, min(size, at + self.task_bytes)) for k, at in enumerate(range(0, max(size, 1), self.task_bytes))]

    def _first(self, f: pa.NativeFile, part: Range) -> int | None:
        """Where the first member of a range begins: a header behind which the next one, or the file's end, is where it says."""
        if part.start == 0:
            return 0
        f.seek(part.start)
        near = f.read(part.end - part.start + 2 * MEMBER_MOST)
        at = near.find(_MAGIC)
        while 0 <= at < part.end - part.start:
            size = member_size(near[at : at + MEMBER_MOST])
            if size and (part.start + at + size == f.size() or member_size(near[at + size : at + size + MEMBER_MOST])):
                return part.start + at
            at = near.find(_MAGIC, at + 1)
        return None

    def _members(self, f: pa.NativeFile, at: int) -> Iterator[tuple[int, bytes]]:
        """(place, text) of the members from a place on."""
        while True:
            f.seek(at)
            head = f.read(MEMBER_MOST)
            if not head:
                return
            size = member_size(head)
            if size is None or size > len(head):
                raise ValueError(f"{self.path} isn't block gzip at {at}")
            yield at, unpacked_member(head[:size])
            at += size

    def read(self, part: Range) -> Iterator[tuple[str, int]]:
        sep = self.separator
        with opened(self.path) as f:
            first = self._first(f, part)
            if first is None:
                return
            members, text, own = self._members(f, first), bytearray(), None
            for at, data in members:
                if at >= part.end and own is None:
                    own = len(text)
                text += data
                if own is not None and len(text) >= own + len(sep) - 1:
                    break
            own = len(text) if own is None else own
            last = own + len(sep) - 1  # separators begin before `own`
            begin, number = 0, 0
            if part.start:
                found = text.find(sep, 0, last)
                if found < 0:
                    return
                begin = found + len(sep)
            while (end := text.find(sep, begin, last)) >= 0:
                yield text[begin:end].decode(), part.number << 40 | number
                begin, number = end + len(sep), number + 1
            looked = begin
            while (end := text.find(sep, looked)) < 0:
                looked = max(begin, len(text) - len(sep) + 1)
                more = next(members, None)
                if more is None:
                    end = len(text)
                    break
                text += more[1]
            yield text[begin:end].decode(), part.number << 40 | number


class BlockGzip(DataSource):
    """value and at (in the file's order) of its records. Options: path, separator (a line end), task_bytes."""

    @classmethod
    def name(cls) -> str:
        return "block_gzip"

    def schema(self) -> str:
        return "value string, at long"

    def reader(self, schema) -> BlockGzipReader:
        return BlockGzipReader(self.options["path"], self.options.get("separator", "\n").encode(), int(self.options.get("task_bytes", TASK_BYTES)))


def read_records(spark: SparkSession, path: str, separator: str = "\n", task_bytes: int = TASK_BYTES) -> DataFrame:
    """value and at of the records of a block gzip file; as many tasks as it has ranges of `task_bytes`."""
    spark.dataSource.register(BlockGzip)
    return spark.read.format("block_gzip").option("path", path).option("separator", separator).option("task_bytes", task_bytes).load()
