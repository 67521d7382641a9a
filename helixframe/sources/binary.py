"""Binary genome files: 2bit sequences and BigWig tracks, by their public layouts, as Python data sources."""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .named_files import opened

TWOBIT, BIGWIG = 0x1A412743, 0x888FFC26
MOST_ROWS, MOST_BASES = 1 << 16, 1 << 24
#: Where 2bit files must have places of 64 bits (version 1).
TWOBIT_BYTES = 1 << 32
#: Bytes of a 2bit index that are read at once, and the most that an entry has.
INDEX_BYTES, ENTRY_MOST = 1 << 20, 1 + 255 + 8
#: Bytes of sections that one task reads of a BigWig file.
TASK_BYTES = 4 << 20
#: How far apart sections may be that are read at once.
NEAR_BYTES = 1 << 12


def sniff(head: bytes) -> str:
    """gzip, 2bit, bigwig or fasta by the first bytes, else an error."""
    if head[:2] == b"\x1f\x8b":
        return "gzip"
    for order in "<>":
        if len(head) >= 4 and struct.unpack(order + "I", head[:4])[0] in (TWOBIT, BIGWIG):
            return {TWOBIT: "2bit", BIGWIG: "bigwig"}[struct.unpack(order + "I", head[:4])[0]]
    if head.lstrip()[:1] == b">":
        return "fasta"
    raise ValueError("neither gzip, 2bit, BigWig nor FASTA")


class _Sections(InputPartition):
    """Sections of a BigWig file by place, and the contigs (number: name, size) that they may have."""

    def __init__(self, places: list[tuple[int, int]], contigs: dict[int, tuple[str, int]]) -> None:
        self.places, self.contigs = places, contigs


class _Sequences(InputPartition):
    """n sequences of a 2bit file by their place in its index, with the bounds of what is read of one (else all of each)."""

    def __init__(self, at: int, n: int, begin: int = 0, end: int | None = None) -> None:
        self.at, self.n, self.begin, self.end = at, n, begin, end


def _order(head: bytes, magic: int) -> str:
    for order in "<>":
        if struct.unpack(order + "I", head)[0] == magic:
            return order
    raise ValueError("not such a file")


class TwoBitReader(DataSourceReader):
    """Each task seeks to its own records, about MOST_BASES / 4 bytes of them: a range of a long sequence, or many short ones.

    Without `piece`, rows are whole sequences. With it they are (chrom, size, tile, piece): `piece` bases each, and the
    `reach` bases that follow, so that a long sequence is many tasks and no row. The driver reads the index in pieces and
    keeps what a task begins with; names are read by tasks. Places have 32 bits in files of version 0 and 64 in version 1.
    """

    def __init__(self, path: str, mask: bool, piece: int = 0, reach: int = 0) -> None:
        self.path, self.mask, self.piece, self.reach = path, mask, piece, reach

    def _head(self, f) -> tuple[str, struct.Struct, int]:
        """The byte order, what a place is, and how many sequences there are."""
        order = _order(f.read(4), TWOBIT)
        version, n, _ = struct.unpack(order + "III", f.read(12))
        if version > 1:
            raise ValueError(f"a 2bit file of version {version}")
        return order, struct.Struct(order + "IQ"[version]), n

    def _entries(self, f, place: struct.Struct, at: int, n: int) -> Iterator[tuple[int, bytes, int]]:
        """(its place in the index, name, place of the record) of n entries of the index from `at` on, which is read in pieces."""
        held, k = b"", 0
        for left in range(n, 0, -1):
            if len(held) - k < ENTRY_MOST:
                f.seek(at + len(held) - k)
                held, k = held[k:] + f.read(min(INDEX_BYTES, left * ENTRY_MOST)), 0
            end = k + 1 + held[k]
            yield at, held[k + 1 : end], place.unpack_from(held, end)[0]
            at, k = at + end + place.size - k, end + place.size

    def partitions(self) -> list[_Sequences]:
        with opened(self.path) as f:
            order, place, n = self._head(f)
            found, many, most, held = [], None, MOST_BASES // 4, 0
            entries = self._entries(f, place, f.tell(), n)
            for (at, _, record), (_, _, following) in itertools.pairwise(itertools.chain(entries, [(0, b"", f.size())])):
                size, weight = 0, following - record
                if not 0 < weight <= most:  # a long one, or one that isn't before the next one's
                    f.seek(record)
                    size = struct.unpack(order + "I", f.read(4))[0]
                    weight = weight if weight > 0 else size // 4
                if self.piece and size > MOST_BASES:
                    step, many = max(self.piece, MOST_BASES // self.piece * self.piece), None
                    found += [_Sequences(at, 1, begin, min(size, begin + step)) for begin in range(0, size, step)]
                    continue
                if many is None or held + weight > most:
                    many, held = _Sequences(at, 0), 0
                    found.append(many)
                many.n += 1
                held += weight
        return found

    def read(self, part: _Sequences) -> Iterator[tuple]:
        with opened(self.path) as f:
            order, place, _ = self._head(f)
            for _, name, at in self._entries(f, place, part.at, part.n):
                chrom = name.decode()
                size, bases = self._bases(f, order, at, part.begin, part.end)
                if not self.piece:
                    yield chrom, bases
                    continue
                end = size if part.end is None else part.end
                for start in range(part.begin, max(end, part.begin + 1), self.piece):
                    yield chrom, size, start // self.piece, bases[start - part.begin : start - part.begin + self.piece + self.reach]

    def _bases(self, f, order: str, at: int, begin: int, end: int | None) -> tuple[int, str]:
        """The size of a sequence, and its bases in [begin, end) and `reach` more; all of them where end is None."""
        f.seek(at)
        numbers = lambda n: np.frombuffer(f.read(4 * n), dtype=order + "u4").astype(np.int64)
        size = int(numbers(1)[0])
        spans = []
        for _ in range(2):
            n = int(numbers(1)[0])
            spans.append((numbers(n), numbers(n)))
        numbers(1)
        end, first = size if end is None else min(end + self.reach, size), begin // 4
        f.seek(f.tell() + first)
        packed = np.frombuffer(f.read((end + 3) // 4 - first), dtype=np.uint8)
        codes = np.stack([packed >> 6, packed >> 4 & 3, packed >> 2 & 3, packed & 3], axis=1).reshape(-1)[begin - 4 * first : end - 4 * first]
        bases = np.frombuffer(b"TCAG", dtype=np.uint8)[codes]
        for k, (starts, lengths) in enumerate(spans if self.mask else spans[:1]):
            near = (starts < end) & (starts + lengths > begin)
            for lo, hi in zip(np.maximum(starts[near] - begin, 0), (starts + lengths)[near] - begin, strict=True):
                if k:
                    bases[lo:hi] |= 32
                else:
                    bases[lo:hi] = ord("N")
        return size, bases.tobytes().decode()


class TwoBitSource(DataSource):
    """Options: path, mask (lower-case what the file masks; false), piece and reach (rows of pieces; see TwoBitReader)."""

    @classmethod
    def name(cls) -> str:
        return "twobit"

    def schema(self) -> str:
        return "chrom string, size long, tile int, piece string" if "piece" in self.options else "chrom string, seq string"

    def reader(self, schema) -> TwoBitReader:
        return TwoBitReader(self.options["path"], self.options.get("mask", "false").lower() == "true", int(self.options.get("piece", 0)), int(self.options.get("reach", 0)))


def read_twobit_pieces(spark: SparkSession, path: str, length: int = 1 << 12, reach: int = 0, mask: bool = False) -> DataFrame:
    """chrom, size, tile and piece of a 2bit file, as genome.pieces has them of whole sequences, without any row for those."""
    register(spark)
    return spark.read.format("twobit").option("path", path).option("mask", str(mask).lower()).option("piece", length).option("reach", reach).load()


class BigWigReader(DataSourceReader):
    """Tasks by leaves of the file's index, TASK_BYTES each, so that a contig is many tasks.

    Of contigs other than `chroms`, and of positions outside [lo, hi), neither index nodes nor sections are read where they
    have no others; values under `least` are left out while they are read.
    """

    def __init__(self, path: str, chroms: set[str] | None = None, lo: int = 0, hi: int | None = None, least: float | None = None) -> None:
        self.path, self.chroms, self.lo, self.hi, self.least = path, chroms, lo, hi, least

    def _header(self, f) -> tuple[str, int, int, int]:
        order = _order(f.read(4), BIGWIG)
        _, _, tree, _, index = struct.unpack(order + "HHQQQ", f.read(28))
        f.seek(52)
        return order, tree, index, struct.unpack(order + "I", f.read(4))[0]

    def _contigs(self, f, order: str, tree: int) -> dict[int, tuple[str, int]]:
        """Number: name and size of the contigs that are asked for."""
        f.seek(tree + 8)
        key = struct.unpack(order + "I", f.read(4))[0]
        found, todo = {}, [tree + 32]
        while todo:
            f.seek(todo.pop())
            leaf, _, n = struct.unpack(order + "BBH", f.read(4))
            for _ in range(n):
                name = f.read(key).rstrip(b"\0").decode()
                if leaf:
                    number, size = struct.unpack(order + "II", f.read(8))
                    if self.chroms is None or name in self.chroms:
                        found[number] = name, size
                else:
                    todo.append(struct.unpack(order + "Q", f.read(8))[0])
        return found

    def _places(self, f, order: str, index: int, contigs: dict[int, tuple[str, int]]) -> np.ndarray:
        """(place, bytes) of the sections that may have what is asked for, by place."""
        corner = [(c, order + "u4") for c in ("c0", "p0", "c1", "p1")]
        kinds = {1: np.dtype([*corner, ("at", order + "u8"), ("size", order + "u8")]), 0: np.dtype([*corner, ("at", order + "u8")])}
        wanted = np.array(sorted(contigs), np.int64)
        found, todo = [np.empty((0, 2), np.int64)], [index + 48]
        while todo:
            f.seek(todo.pop())
            leaf, _, n = struct.unpack(order + "BBH", f.read(4))
            nodes = np.frombuffer(f.read(n * kinds[leaf].itemsize), kinds[leaf])
            first, last = np.searchsorted(wanted, nodes["c0"]), np.searchsorted(wanted, nodes["c1"], "right")
            # a contig that is asked for is within; if it is the only one, positions can tell too
            kept, alone = last > first, nodes["c0"] == nodes["c1"]
            kept &= ~alone | (nodes["p1"] > self.lo)
            if self.hi is not None:
                kept &= ~alone | (nodes["p0"] < self.hi)
            if leaf:
                found.append(np.stack([nodes["at"][kept], nodes["size"][kept]], 1).astype(np.int64))
            else:
                todo += nodes["at"][kept].tolist()
        places = np.concatenate(found)
        return places[np.argsort(places[:, 0])]

    def partitions(self) -> list[_Sections]:
        with opened(self.path) as f:
            order, tree, index, _ = self._header(f)
            contigs = self._contigs(f, order, tree)
            places = self._places(f, order, index, contigs)
        before = np.cumsum(places[:, 1]) - places[:, 1]
        edges = np.flatnonzero(np.diff(before // TASK_BYTES)) + 1
        return [_Sections([tuple(p) for p in own.tolist()], contigs) for own in np.split(places, edges) if len(own)] or [_Sections([], {})]

    def read(self, part: _Sections) -> Iterator[pa.RecordBatch]:
        with opened(self.path) as f:
            order, _, _, packed = self._header(f)
            k = 0
            while k < len(part.places):
                end = k + 1  # sections that are next to each other come with one read
                while end < len(part.places) and part.places[end][0] - sum(part.places[end - 1]) <= NEAR_BYTES and sum(part.places[end]) - part.places[k][0] <= TASK_BYTES:
                    end += 1
                first = part.places[k][0]
                f.seek(first)
                data = f.read(sum(part.places[end - 1]) - first)
                for offset, size in part.places[k:end]:
                    section = data[offset - first : offset - first + size]
                    yield from self._section(zlib.decompress(section) if packed else section, order, part)
                k = end

    def _section(self, data: bytes, order: str, part: _Sections) -> Iterator[pa.RecordBatch]:
        """The positions of a section that have a value, as Arrow batches of at most MOST_ROWS (or one item's) rows."""
        number, start, _, step, span, kind, _, n = struct.unpack(order + "IIIIIBBH", data[:24])
        if number not in part.contigs:
            return
        name, size = part.contigs[number]
        if kind == 1:
            rows = np.frombuffer(data, dtype=np.dtype([("s", order + "u4"), ("e", order + "u4"), ("v", order + "f4")]), count=n, offset=24)
            starts, ends, values = rows["s"], rows["e"], rows["v"]
        elif kind == 2:
            rows = np.frombuffer(data, dtype=np.dtype([("s", order + "u4"), ("v", order + "f4")]), count=n, offset=24)
            starts, ends, values = rows["s"], rows["s"] + span, rows["v"]
        else:
            values = np.frombuffer(data, dtype=order + "f4", count=n, offset=24)
            starts = start + step * np.arange(n, dtype=np.int64)
            ends = starts + span
        starts, ends = starts.astype(np.int64), np.minimum(ends.astype(np.int64), size if self.hi is None else min(size, self.hi))
        starts = np.maximum(starts, self.lo)
        kept = (ends > starts) & (values >= np.float32(-np.inf if self.least is None else self.least))  # not where the value is NaN
        starts, lengths, values = starts[kept], (ends - starts)[kept], values[kept].astype(np.float32)
        total = np.cumsum(lengths)
        while len(lengths):
            n = max(1, int(np.searchsorted(total - total[0] + lengths[0], MOST_ROWS, side="right")))
            own = lengths[:n]
            pos = np.repeat(starts[:n] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            names = pa.DictionaryArray.from_arrays(np.zeros(len(pos), dtype=np.int32), [name]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(pos), pa.array(np.repeat(values[:n], own))], names=["chrom", "pos", "score"])
            starts, lengths, values, total = starts[n:], lengths[n:], values[n:], total[n:]


class BigWigSource(DataSource):
    """chrom, pos (from 0) and score of every position with a value. Options: path; chroms (names, a tab between), start, end and least."""

    @classmethod
    def name(cls) -> str:
        return "bigwig"

    def schema(self) -> str:
        return "chrom string, pos long, score float"

    def reader(self, schema) -> BigWigReader:
        o = self.options
        number = lambda key, kind: kind(o[key]) if key in o else None
        return BigWigReader(o["path"], set(o["chroms"].split("\t")) if "chroms" in o else None, max(0, number("start", int) or 0), number("end", int), number("least", float))


def read_bigwig(spark: SparkSession, path: str, chroms: list[str] | None = None, start: int | None = None, end: int | None = None, least: float | None = None) -> DataFrame:
    """Values of `chroms` in [start, end) that are `least` or more; what is left out isn't read.

    These are options and not filters that Spark pushes: Spark 4.1 keeps what one query pushed to a Python source for later
    queries over the same frame, which would lack rows.
    """
    register(spark)
    rows = spark.read.format("bigwig").option("path", path)
    for key, value in (("chroms", None if chroms is None else "\t".join(chroms)), ("start", start), ("end", end), ("least", least)):
        rows = rows if value is None else rows.option(key, value)
    return rows.load()


def register(spark: SparkSession) -> None:
    """Make the formats `twobit` and `bigwig` known."""
    spark.dataSource.register(TwoBitSource)
    spark.dataSource.register(BigWigSource)


_CODE = np.full(256, 255, dtype=np.uint8)
for _k, _letter in enumerate("TCAG"):
    _CODE[ord(_letter)] = _CODE[ord(_letter.lower())] = _k


def twobit_body(seq: str) -> bytes:
    """A sequence as a 2bit file has it: letters other than A, C, G and T are N, lower case is masked."""

    def spans(marks: np.ndarray) -> bytes:
        edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
        starts, ends = edge[::2], edge[1::2]
        return struct.pack("<I", len(starts)) + starts.astype("<u4").tobytes() + (ends - starts).astype("<u4").tobytes()

    letters = np.frombuffer(seq.encode(), dtype=np.uint8)
    codes = _CODE[letters]
    two = np.concatenate([np.where(codes == 255, 0, codes), np.zeros(-len(codes) % 4, dtype=np.uint8)]).reshape(-1, 4)
    packed = two[:, 0] << 6 | two[:, 1] << 4 | two[:, 2] << 2 | two[:, 3]
    return struct.pack("<I", len(letters)) + spans(codes == 255) + spans((letters >= 97) & (letters <= 122)) + struct.pack("<I", 0) + packed.astype(np.uint8).tobytes()


def twobit_head(n: int, long: bool = False) -> bytes:
    """long: the index has places of 64 bits."""
    return struct.pack("<IIII", TWOBIT, int(long), n, 0)


def twobit_entry(name: bytes, at: int, long: bool = False) -> bytes:
    """What the index has of a sequence: its name and place."""
    return bytes([len(name)]) + name + struct.pack("<Q" if long else "<I", at)


def pack_twobit(records: list[tuple[str, str]]) -> bytes:
    """A 2bit file of a few (name, sequence); see sinks.write_twobit."""
    names, bodies = [n.encode() for n, _ in records], [twobit_body(seq) for _, seq in records]
    at, index = 16 + sum(len(n) + 5 for n in names), []
    for name, body in zip(names, bodies, strict=True):
        index.append(twobit_entry(name, at))
        at += len(body)
    return twobit_head(len(records)) + b"".join(index) + b"".join(bodies)


def bigwig_section(number: int, starts: np.ndarray, values: np.ndarray) -> bytes:
    """A compressed section of single bases of a contig, in order."""
    rows = np.empty(len(starts), np.dtype([("s", "<u4"), ("e", "<u4"), ("v", "<f4")]))
    rows["s"], rows["e"], rows["v"] = starts, starts + 1, values
    return zlib.compress(struct.pack("<IIIIIBBH", number, int(starts[0]), int(starts[-1]) + 1, 0, 0, 1, 0, len(rows)) + rows.tobytes())


def bigwig_head(contigs: list[tuple[str, int]], data: int) -> bytes:
    """Everything before the sections (`data` bytes of them): the header and the contigs, by number, with their sizes."""
    names = [n.encode() for n, _ in contigs]
    key = max([len(n) for n in names], default=1)
    items = b"".join(n.ljust(key, b"\0") + struct.pack("<II", k, size) for k, (n, (_, size)) in enumerate(zip(names, contigs, strict=True)))
    tree = struct.pack("<IIIIQQBBH", 0x78CA8C91, max(1, len(names)), key, 8, len(names), 0, 1, 0, len(names)) + items
    return struct.pack("<IHHQQQHHQQIQ", BIGWIG, 4, 0, 64, 64 + len(tree), 64 + len(tree) + data, 0, 0, 0, 0, 1 << 16, 0) + tree


def bigwig_root(nodes: list[tuple[int, int, int, int, int]], sections: int, at: int) -> bytes:
    """The index's header, and its root: bounds and number of items of each leaf node. They follow the root, which begins behind a header at `at`."""
    place, items = at + 48 + 4 + 24 * len(nodes), []
    for c0, p0, c1, p1, n in nodes:
        items.append(struct.pack("<IIIIQ", c0, p0, c1, p1, place))
        place += 4 + 32 * n
    return struct.pack("<IIQIIIIQII", 0x2468ACE0, max(1, len(nodes)), sections, 0, 0, 0, 0, at, 1, 0) + struct.pack("<BBH", 0, 0, len(nodes)) + b"".join(items)


def pack_bigwig(values: list[tuple[str, int, float]], per_section: int = 1024) -> bytes:
    """A BigWig file of a few (chrom, position, score), one base each (see sinks.write_bigwig): sections of (start, end, score), compressed, one index node."""
    rows: dict[str, list[tuple[int, float]]] = {}
    for chrom, pos, score in values:
        rows.setdefault(chrom, []).append((pos, score))
    names = sorted(rows)
    key = max([len(n.encode()) for n in names], default=1)
    items = b"".join(n.encode().ljust(key, b"\0") + struct.pack("<II", k, max(p for p, _ in rows[n]) + 1) for k, n in enumerate(names))
    tree = struct.pack("<IIIIQQBBH", 0x78CA8C91, max(1, len(names)), key, 8, len(names), 0, 1, 0, len(names)) + items
    at, data, leaves = 64 + len(tree), [], []
    for k, n in enumerate(names):
        own = sorted(rows[n])
        for i in range(0, len(own), per_section):
            part = own[i : i + per_section]
            body = b"".join(struct.pack("<IIf", p, p + 1, v) for p, v in part)
            packed = zlib.compress(struct.pack("<IIIIIBBH", k, part[0][0], part[-1][0] + 1, 0, 0, 1, 0, len(part)) + body)
            leaves.append(struct.pack("<IIIIQQ", k, part[0][0], k, part[-1][0] + 1, at, len(packed)))
            data.append(packed)
            at += len(packed)
    index = struct.pack("<IIQIIIIQII", 0x2468ACE0, max(1, len(leaves)), len(leaves), 0, 0, 0, 0, 0, 1, 0) + struct.pack("<BBH", 1, 0, len(leaves)) + b"".join(leaves)
    head = struct.pack("<IHHQQQHHQQIQ", BIGWIG, 4, 0, 64, 64 + len(tree), at, 0, 0, 0, 0, 1 << 16, 0)
    return head + tree + b"".join(data) + index
