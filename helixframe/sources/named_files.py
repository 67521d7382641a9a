"""Files with fixed names: written by many tasks, there only once all of them are written, and whole.

Each task writes what it has of a file under a name of its own, and a list of what it wrote; the driver gets the lists' places
only. On commit, tasks move files of one part to their place, and join the parts of others, a file each, and then move them. Failed attempts leave nothing under a fixed name, and
what they wrote goes with the run's folder. Any file system that Arrow opens will do (mounted paths, HDFS, object stores).
"""

from __future__ import annotations

import gzip
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..storage import checkpointed

#: Files that one task opens by name.
FILES_A_TASK = 4096


def at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    return fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path.removeprefix("file:")))


def opened(path: str) -> pa.NativeFile:
    """A file to read from anywhere in it."""
    system, where = at(path)
    return system.open_input_file(where)


def names_in(folder: str) -> list[str] | None:
    """Names of a folder's files, in order; None where it isn't a folder."""
    system, where = at(folder)
    if system.get_file_info(where).type != fs.FileType.Directory:
        return None
    return sorted(f.base_name for f in system.get_file_info(fs.FileSelector(where)))


@dataclass
class Parts(WriterCommitMessage):
    """Where the list is of what a task wrote: lines of file, partition, where."""

    listed: str | None


class NamedFilesWriter(DataSourceArrowWriter):
    """Rows (file, value): values of a file are written one after the other, in the order of partitions and of rows in them."""

    def __init__(self, folder: str, run: str, gz: bool) -> None:
        self.folder, self.run, self.gz = folder, run, gz

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        system, run = at(self.run)
        system.create_dir(f"{run}/tried", recursive=True)
        number, out, name, written = TaskContext.get().partitionId(), None, None, []
        try:
            for batch in iterator:
                for file, value in zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True):
                    if file != name:
                        if out:
                            out.close()
                        name = file
                        written.append((file, number, f"{run}/tried/{uuid.uuid4().hex}"))
                        out = system.open_output_stream(written[-1][2], compression=None)
                        out = gzip.GzipFile(fileobj=out, mode="wb", mtime=0) if self.gz else out
                    out.write(value.encode() if isinstance(value, str) else value)
        finally:
            if out:
                out.close()
        if not written:
            return Parts(None)
        listed = f"{run}/listed/{uuid.uuid4().hex}"
        system.create_dir(f"{run}/listed", recursive=True)
        with system.open_output_stream(listed) as out:
            out.write("".join(f"{file}\t{number}\t{where}\n" for file, number, where in written).encode())
        return Parts(listed)

    def commit(self, messages: list[Parts | None]) -> None:
        (system, run), (_, folder) = at(self.run), at(self.folder)
        system.create_dir(run, recursive=True)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{run}/made") as out:
            out.write("\n".join(m.listed for m in messages if m and m.listed).encode())

    def abort(self, messages: list[Parts | None]) -> None:
        system, run = at(self.run)
        if system.get_file_info(run).type == fs.FileType.Directory:
            system.delete_dir(run)


class NamedFiles(DataSource):
    """Options: path (the folder), run (a new folder for parts), gz."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "file string, value string"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], self.options["run"], self.options.get("gz", "false") == "true")


def write_files(rows: DataFrame, folder: str, gz: bool = False) -> DataFrame:
    """Writes rows (file, value: text or bytes), as they are dealt and ordered, to files of these names in `folder`; their names (file)."""
    spark = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    run = f"{folder}/.parts-{uuid.uuid4().hex}"
    rows.select("file", "value").write.format("named_files").option("path", folder).option("run", run).option("gz", str(gz).lower()).mode("append").save()
    system, where = at(run)
    with system.open_input_stream(f"{where}/made") as f:
        lists = [(line,) for line in f.read().decode().split("\n") if line]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = at(run)
        for batch in batches:
            for listed in batch["listed"].to_pylist():
                with system.open_input_stream(listed) as f:
                    own = [line.split("\t") for line in f.read().decode().split("\n") if line]
                yield pa.record_batch([pa.array([o[0] for o in own], pa.string()), pa.array([int(o[1]) for o in own], pa.int64()), pa.array([o[2] for o in own], pa.string())], names=["file", "number", "where"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (system, where), (_, to) = at(run), at(folder)
        for batch in batches:
            for file, own in zip(batch["file"].to_pylist(), batch["parts"].to_pylist(), strict=True):
                one = own[0]["where"]
                if len(own) > 1:
                    one = f"{where}/tried/{uuid.uuid4().hex}"
                    with system.open_output_stream(one, compression=None) as out:
                        for part in own:
                            with system.open_input_stream(part["where"], compression=None) as f:
                                shutil.copyfileobj(f, out, 1 << 22)
                elif system.get_file_info(one).type == fs.FileType.NotFound and system.get_file_info(f"{to}/{file}").type == fs.FileType.File:
                    continue  # an attempt before this one moved it
                system.move(one, f"{to}/{file}")
            yield pa.record_batch([batch["file"]], names=["file"])

    listed = spark.createDataFrame(lists, "listed string").repartition(max(1, min(len(lists), 1000)), "listed")
    files = listed.mapInArrow(parts, "file string, number long, where string").groupBy("file").agg(F.array_sort(F.collect_list(F.struct("number", "where"))).alias("parts"))
    made = checkpointed(files.mapInArrow(settle, "file string"))
    system.delete_dir(where)
    return made


def _split(stream: pa.NativeFile | gzip.GzipFile, sep: bytes) -> Iterator[bytes]:
    """What is between separators, read in pieces of 4 MB."""
    held = bytearray()
    while piece := stream.read(1 << 22):
        seen = max(0, len(held) - len(sep) + 1)
        held += piece
        while (end := held.find(sep, seen)) >= 0:
            yield bytes(held[:end])
            del held[: end + len(sep)]
            seen = 0
    yield bytes(held)


def read_named(names: DataFrame, folder: str, sep: str) -> DataFrame:
    """file, at (from 0 in each file) and value of what `sep` divides in files of `folder` by name (file); gzip by name.

    Tasks open the files by name, about FILES_A_TASK each, so that nobody lists the folder: of each file that Spark
    lists, the driver keeps a status. `names` are counted first, and a file is one task's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (system, where), rows, size = at(folder), [], 0
        made = lambda: pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.binary()))], names=["file", "at", "value"])
        for batch in batches:
            for file in batch["file"].to_pylist():
                with system.open_input_stream(f"{where}/{file}", compression=None) as f:
                    for k, value in enumerate(_split(gzip.GzipFile(fileobj=f) if file.endswith(".gz") else f, sep.encode())):
                        rows.append((file, k, value))
                        size += len(value)
                        if size >= 1 << 22 or len(rows) >= 10_000:
                            yield made()
                            rows, size = [], 0
        yield made()

    tasks = max(names.sparkSession.sparkContext.defaultParallelism, -(-names.count() // FILES_A_TASK))
    return names.select("file").repartition(tasks, "file").mapInArrow(run, "file string, at long, value binary").withColumn("value", F.col("value").cast("string"))


def write_named(rows: DataFrame, folder: str, gz: bool = False) -> list[str]:
    """As write_files, where the files are few; their names, in order."""
    return sorted(r.file for r in write_files(rows, folder, gz).collect())
