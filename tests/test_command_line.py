import pytest

from helixframe import __main__ as cli


def test_defaults():
    a = cli.parser().parse_args(["chunk"])
    assert (a.sequence, a.chunk, a.flank, a.min_contig, a.gzip, a.outdir) == ("-", 6_000_000, 50_000, 500, False, ".")
    assert cli.parser().parse_args(["chunk", "--gzip"]).gzip
    d = cli.parser().parse_args(["derive", "--bigwigs", "b", "--regions", "r"])
    assert (d.floor, d.ceiling, d.prefix) == (-4, 13, "spliceai")
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["derive"])


def test_junctions_by_command(spark, tmp_path):
    (tmp_path / "a.tab").write_text("c 1 60 + 1 0 9 1 10\n")
    cli.run(spark, cli.parser().parse_args(["join-junctions", "--junctions", str(tmp_path / "a.tab"), "--outdir", str(tmp_path)]))
    assert [r.value for r in spark.read.text(str(tmp_path / "ALL_SJ_out_filtered.tab")).collect()] == ["c\t1\t60\t+\t1\t1\t9\t1\t10"]
