"""Files with fixed names: whole, in order, only on commit; and BigWig files read by the leaves of their index."""

import gzip
import pickle
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helixframe.operators import genome
from helixframe.sources import binary, block_gzip, named_files, sinks


def listed(folder):
    return sorted(p.name for p in folder.iterdir())


@pytest.mark.parametrize("gz", [False, True])
def test_parts_of_a_file_are_joined_in_order(spark, tmp_path, gz):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, "big").otherwise(F.concat(F.lit("small"), F.col("id") % 3)).alias("file"), "id", F.concat(F.col("id").cast("string"), F.lit("\n")).alias("value"))
    dealt = rows.repartitionByRange(7, "file", "id").sortWithinPartitions("file", "id")
    assert named_files.write_named(dealt, str(tmp_path), gz) == listed(tmp_path) == ["big", "small0", "small1", "small2"]
    read = (lambda p: gzip.open(p, "rt").read()) if gz else (lambda p: p.read_text())
    assert read(tmp_path / "big").split() == [str(k) for k in range(900)]
    assert [int(x) for x in read(tmp_path / "small1").split()] == [k for k in range(900, 1000) if k % 3 == 1]
    # what is there is replaced, nothing else is touched, and a URI will do
    assert named_files.write_named(rows.filter("id = 3"), f"file://{tmp_path}") == ["big"]
    assert (tmp_path / "big").read_bytes() == b"3\n" and len(listed(tmp_path)) == 4
    assert named_files.write_named(rows.filter("id < 0"), str(tmp_path / "none")) == []


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    value = F.when(F.col("id") == 99, F.raise_error(F.lit("no more")).cast("string")).otherwise("x")
    with pytest.raises(Exception, match="no more"):
        named_files.write_named(spark.range(0, 100, 1, 4).select(F.concat(F.lit("f"), F.col("id") % 3).alias("file"), value.alias("value")), str(tmp_path))
    assert listed(tmp_path) == []


def test_wig_by_ranges(spark, tmp_path):
    rows = [("chr1", 100 * k, "+", [0.5, 0.25], [0.0, 0.125]) for k in range(500)] + [("chr2", 7, "-", [1.0], [0.5])]
    scored = spark.createDataFrame(rows, "chrom string, start long, strand string, acceptor array<double>, donor array<double>").repartition(5)
    assert sinks.write_wig(scored, str(tmp_path), "x") == listed(tmp_path) and len(listed(tmp_path)) == 4
    lines = (tmp_path / "x.acceptor_plus.wig").read_text().splitlines()
    assert [x for x in lines if x.startswith("fixed")] == [f"fixedStep chrom=chr1 start={100 * k + 2} step=1" for k in range(500)] and lines[1:3] == ["0.5", "0.25"]
    assert (tmp_path / "x.donor_minus.wig").read_text() == "fixedStep chrom=chr2 start=9 step=1\n0.5\n"
    assert sinks.write_wig(scored.filter("chrom = 'none'"), str(tmp_path / "e"), "x") == listed(tmp_path / "e") and (tmp_path / "e" / "x.donor_plus.wig").read_bytes() == b""


VALUES = [("chr1", 3 * k, (k % 100) / 100) for k in range(50_000)] + [("chr2", k, 0.5) for k in range(2000)] + [("chr3", 9, 1.0)]


@pytest.fixture(scope="module")
def track(tmp_path_factory):
    at = tmp_path_factory.mktemp("bw") / "x.bw"
    at.write_bytes(binary.pack_bigwig(random.Random(1).sample(VALUES, len(VALUES)), 100))
    return str(at)


def read(track, **limits):
    reader = binary.BigWigReader(track, **limits)
    parts = reader.partitions()
    rows = [row for p in parts for batch in reader.read(p) for row in zip(*batch.to_pydict().values(), strict=True)]
    return rows, sum(len(p.places) for p in parts), parts


def test_a_contig_is_many_tasks_and_what_isnt_asked_for_isnt_read(track, monkeypatch):
    monkeypatch.setattr(binary, "TASK_BYTES", 10_000)
    rows, every, parts = read(track)
    assert sorted(rows) == sorted((c, p, float(binary.np.float32(v))) for c, p, v in VALUES) and every == 521 and len(parts) > 20
    rows, n, _ = read(track, chroms={"chr1"}, lo=75_000, hi=76_500)
    assert sorted(r[:2] for r in rows) == [("chr1", p) for p in range(75_000, 76_500, 3)] and n <= 7  # about 1 % of chr1
    rows, n, _ = read(track, chroms={"chr2", "chr3", "chr9"})
    assert len(rows) == 2001 and n == 21
    rows, n, parts = read(track, chroms={"chr9"})
    assert rows == [] and n == 0 and len(parts) == 1
    assert len(read(track, lo=9, hi=10)[0]) == 3


def test_range_in_spark(spark, track):
    got = binary.read_bigwig(spark, f"file://{track}", ["chr1"], 300, 330, 0.055)
    assert got.count() == sum(c == "chr1" and 300 <= p < 330 and v > 0.055 for c, p, v in VALUES)
    assert binary.read_bigwig(spark, track, ["chr2", "chr3"]).count() == 2001
    # one frame in two branches
    rows = binary.read_bigwig(spark, track)
    assert rows.filter("chrom = 'chr2'").unionAll(rows.filter("chrom = 'chr3'")).count() == 2001 and rows.count() == len(VALUES)


@pytest.mark.parametrize("mask", [False, True])
def test_twobit_by_ranges(spark, tmp_path, monkeypatch, mask):
    rng = random.Random(9)
    seqs = {f"c{n}": "".join(rng.choice(["ACGT", "acgt", "N", "n", "TTGA"]) for _ in range(n))[:n] for n in (0, 1, 5, 63, 64, 65, 3000)}
    at = str(tmp_path / "g.2bit")
    (tmp_path / "g.2bit").write_bytes(binary.pack_twobit(list(seqs.items())))
    shown = {n: s if mask else s.upper() for n, s in seqs.items()}
    monkeypatch.setattr(binary, "MOST_BASES", 200)
    for length, reach in ((64, 0), (64, 10), (7, 7), (1000, 3)):
        reader = binary.TwoBitReader(at, mask, length, reach)
        parts = reader.partitions()
        got = [r for p in parts for r in reader.read(p)]
        assert got == [(n, len(s), k, s[k * length : (k + 1) * length + reach]) for n, s in shown.items() for k in range(max(1, -(-len(s) // length)))]
        assert len(parts) > 3
    assert dict(r for p in binary.TwoBitReader(at, mask).partitions() for r in binary.TwoBitReader(at, mask).read(p)) == shown
    asked = spark.createDataFrame([("c3000", 0, 3000), ("c3000", 17, 99), ("c65", 64, 65), ("c65", 60, 70)], "chrom string, start long, end long")
    cut = genome.cut(asked, None, tiled=binary.read_twobit_pieces(spark, at, 4096, 4096, mask))
    assert sorted((r.chrom, r.start, r.end, r.seq) for r in cut.collect()) == sorted((c, s, e, shown[c][s:e] if e <= len(shown[c]) else None) for c, s, e in map(tuple, asked.collect()))


def test_a_twobit_file_of_any_size(spark, tmp_path, monkeypatch):
    rng = random.Random(7)
    seqs = {f"c{k}" + "x" * (k % 240): "".join(rng.choices("ACGTNacgt", k=rng.choice([0, 1, 7, 400, 900]))) for k in range(300)}
    genome = spark.createDataFrame(list(seqs.items()), "chrom string, seq string").repartition(5, "chrom")
    short = open(sinks.write_twobit(genome, str(tmp_path), "short.2bit"), "rb").read()
    monkeypatch.setattr(binary, "TWOBIT_BYTES", len(short), raising=False)  # what 4 GB are otherwise
    at = sinks.write_twobit(genome, str(tmp_path), "long.2bit")
    long = open(at, "rb").read()
    assert short[4:8] == b"\0\0\0\0" and long[4:8] == b"\1\0\0\0" and len(long) == len(short) + 4 * len(seqs)
    first = 16 + sum(len(n) + 9 for n in seqs)
    assert int.from_bytes(long[17 + long[16] :][:8], "little") == first and long[first:] == short[first - 4 * len(seqs) :]
    # places beyond 32 bits, in a file that is mostly a hole
    far = 5 << 30
    with open(tmp_path / "far.2bit", "wb") as f:
        f.write(binary.twobit_head(2, True) + binary.twobit_entry(b"near", 100, True) + binary.twobit_entry(b"far", far, True))
        for place, seq in ((100, "ACGTN"), (far, "TTTGA" * 50)):
            f.seek(place)
            f.write(binary.twobit_body(seq))
    assert {r.chrom: r.seq for r in spark.read.format("twobit").option("path", str(tmp_path / "far.2bit")).load().collect()} == {"near": "ACGTN", "far": "TTTGA" * 50}
    for bases, index in ((1 << 24, 1 << 20), (600, 300), (4, 1)):  # many short ones a task, entries that are divided by the pieces of a read
        monkeypatch.setattr(binary, "MOST_BASES", bases)
        monkeypatch.setattr(binary, "INDEX_BYTES", max(index, binary.ENTRY_MOST))
        for path in (at, str(tmp_path / "short.2bit")):
            reader = binary.TwoBitReader(path, True, 100, 30)
            parts = reader.partitions()
            got = [r for p in parts for r in reader.read(p)]
            assert sorted(got) == sorted((n, len(s), k, s[k * 100 : k * 100 + 130]) for n, s in seqs.items() for k in range(max(1, -(-len(s) // 100))))
            assert (len(parts) == 1) == (bases == 1 << 24) and all(len(pickle.dumps(p)) < 200 for p in parts)
            assert dict(r for p in binary.TwoBitReader(path, True).partitions() for r in binary.TwoBitReader(path, True).read(p)) == seqs
    # records that are in another order than the index
    bodies = {n: binary.twobit_body(s) for n, s in seqs.items()}
    place, places = 16 + sum(len(n) + 5 for n in seqs), {}
    for n in reversed(seqs):
        places[n] = place
        place += len(bodies[n])
    (tmp_path / "back.2bit").write_bytes(binary.twobit_head(len(seqs)) + b"".join(binary.twobit_entry(n.encode(), places[n]) for n in seqs) + b"".join(bodies[n] for n in reversed(seqs)))
    reader = binary.TwoBitReader(str(tmp_path / "back.2bit"), True)
    assert dict(r for p in reader.partitions() for r in reader.read(p)) == seqs


def test_binary_files_are_written_by_many_tasks(spark, tmp_path):
    rng = random.Random(6)
    seqs = [(f"c{k}", "".join(rng.choices("ACGTNacgt", k=rng.choice([0, 1, 7, 400])))) for k in range(60)]
    genome = spark.createDataFrame(seqs, "chrom string, seq string").repartition(5, "chrom")
    at = sinks.write_twobit(genome, str(tmp_path))
    data = open(at, "rb").read()
    assert data == binary.pack_twobit([tuple(r) for r in genome.collect()])
    values = [(f"c{rng.randrange(4)}", k, rng.randrange(9) / 8) for k in range(3000)]
    rows = spark.createDataFrame(values, "chrom string, pos long, score float").repartition(5)
    at = sinks.write_bigwig(rows, str(tmp_path), per_section=50, per_node=4)
    assert sorted(map(tuple, binary.read_bigwig(spark, at).collect())) == sorted(values)
    assert sorted(map(tuple, binary.read_bigwig(spark, at, ["c2"], 700, 900, 0.5).collect())) == sorted(v for v in values if v[0] == "c2" and 700 <= v[1] < 900 and v[2] >= 0.5)
    assert binary.read_bigwig(spark, sinks.write_bigwig(rows.limit(0), str(tmp_path), "none.bw")).count() == 0
    lines = spark.range(5000).selectExpr("cast(id as string) value").repartition(5, "value")
    at = sinks.write_block_gzip(lines, str(tmp_path), "l.gz", 700)
    assert [r.value for r in block_gzip.read_records(spark, at, task_bytes=500).orderBy("at").collect() if r.value] == [r.value for r in lines.collect()]
    assert gzip.open(at).read().count(b"\n") == 5000


def test_the_driver_gets_a_place_a_task_and_not_a_name_a_file(spark, tmp_path, monkeypatch):
    writer = named_files.NamedFilesWriter(str(tmp_path), str(tmp_path / ".run"), False)
    monkeypatch.setattr(named_files, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 3})())}))
    rows = pa.record_batch([pa.array([f"f{k}" for k in range(500)]), pa.array(["x"] * 500)], names=["file", "value"])
    assert len(pickle.dumps(writer.write(iter([rows])))) < 500
    monkeypatch.undo()
    made = named_files.write_files(spark.range(500).select(F.concat(F.lit("f"), "id").alias("file"), F.lit("x").alias("value")), str(tmp_path / "all"))
    assert made.count() == 500 == len(listed(tmp_path / "all"))
