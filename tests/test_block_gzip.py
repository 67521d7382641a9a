"""Block gzip read from many places, against the whole."""

import gzip
import random

import pytest

from helixframe.sources import block_gzip as bg, text


def read(path, separator, task_bytes):
    reader = bg.BlockGzipReader(str(path), separator, task_bytes)
    parts = reader.partitions()
    return [r for p in parts for r in reader.read(p)], parts


@pytest.mark.parametrize("separator", [b"\n", b"\n>", b"--x--"])
def test_records_at_any_bounds(tmp_path, separator):
    rng = random.Random(5)
    at = tmp_path / "x.gz"
    for size in (1, 7, 100, 5000):
        data = b"".join(rng.choice([separator, b"A", b"CG\n", b"-x", b">", bytes(rng.choices(b"ACGT", k=rng.randrange(1, 400)))]) for _ in range(300))
        at.write_bytes(bg.pack(data, size))
        assert gzip.decompress(at.read_bytes()) == data
        for task in (1, 60, 333, 4000, 1 << 20):
            if at.stat().st_size / task < 3000:
                rows, parts = read(at, separator, task)
                assert [v.encode() for v, _ in rows] == data.split(separator), (size, task)
                places = [p for _, p in rows]
                assert places == sorted(set(places)) and len(parts) == -(-at.stat().st_size // task)


def test_a_header_within_a_member_is_told_from_one(tmp_path):
    """Stored bytes that look like a member's header, sizes included, don't begin one."""
    import struct
    import zlib

    fake = bg._MAGIC + b"\0\0\0\0\0\xff" + struct.pack("<HBBHH", 6, 66, 67, 2, 500)
    body = b"\1" + struct.pack("<HH", 900, 0xFFFF ^ 900) + (fake + b"n" * 900)[:900]
    part = zlib.decompress(body, -15)
    member = bg._MAGIC + b"\0\0\0\0\0\xff" + struct.pack("<HBBHH", 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    at = tmp_path / "x.gz"
    at.write_bytes(member + bg.pack(b"a\nb\n"))
    reader = bg.BlockGzipReader(str(at), b"\n", 10)
    with bg.opened(str(at)) as f:
        assert {reader._first(f, p) for p in reader.partitions()} == {0, None, len(member), *(len(member) + k for k in range(1, 200) if at.read_bytes()[len(member) + k :].startswith(bg._MAGIC))}


def test_fasta_in_many_tasks(spark, tmp_path):
    rng = random.Random(6)
    seqs = {f"c{k}": "".join(rng.choices("ACGTN", k=rng.randrange(0, 30_000))) for k in range(40)}
    whole = "".join(f">{n}\n" + "".join(s[i : i + 60] + "\n" for i in range(0, len(s), 60)) for n, s in seqs.items())
    for name in ("g.fa.gz", "plainname"):
        (tmp_path / name).write_bytes(bg.pack(whole.encode(), 3000))
        for mode in ("lenient", "strict", "predict"):
            assert {r.chrom: r.seq for r in text.read_fasta(spark, str(tmp_path / name), mode, 1 << 14).collect()} == seqs
    assert bg.read_records(spark, str(tmp_path / "g.fa.gz"), "\n>", 1 << 14).rdd.getNumPartitions() > 10
    (tmp_path / "h.fa.gz").write_bytes(bg.pack(b"AC\n>x\nGT\n", 4))
    assert [tuple(r) for r in text.read_fasta(spark, str(tmp_path / "h.fa.gz")).collect()] == [("x", "ACGT")]
    (tmp_path / "bad.fa.gz").write_bytes(bg.pack(b">x\nGT\n" * 50, 9)[:-40] + b"rubbish")
    with pytest.raises(Exception, match="isn't block gzip"):
        text.read_fasta(spark, str(tmp_path / "bad.fa.gz")).collect()


def test_letters_before_headers_in_a_folder(spark, tmp_path):
    (tmp_path / "a.fa").write_text("GG\nTT\n>x y\nAC\n>z\nT\n")
    (tmp_path / "b.fa").write_text(">q\nAC\n>r\nG\n")
    (tmp_path / "c.fa").write_text("ACG\nT\n")
    (tmp_path / "d.fa").write_text("\n\n>s\nA\n")
    got = {r.chrom: r.seq for r in text.read_fasta(spark, str(tmp_path / "*.fa")).collect()}
    assert got == {"x y": "GGTTAC", "z": "T", "q": "AC", "r": "G", "s": "A"}
    assert {r.chrom: r.seq for r in text.read_fasta(spark, f"{tmp_path}/b.fa").collect()} == {"q": "AC", "r": "G"}
