import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helixframe.functions import sequence as q
from helixframe.operators import genome, intervals, junctions, ordering
from helixframe.plans import pipelines


def loop(start, end, most, tail=10):
    """Windows cut one by one."""
    out = []
    while start < end:
        stop = min(start + most, end)
        if stop == end and end - start < tail and out:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, stop))
        start = stop
    return out


def cut(spark, rows, most):
    frame = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(rows)], "k int, start long, end long")
    got = {r.k: [tuple(w) for w in r.w] for r in frame.select("k", intervals.windows(F.col("start"), F.col("end"), most).alias("w")).collect()}
    return [got[k] for k in range(len(rows))]


def test_windows(spark):
    rng = random.Random(0)
    for most in (1, 7, 10, 33, 64, 500):
        starts = [rng.randrange(3 * most) for _ in range(60)]
        rows = [(a, a + rng.choice((rng.randrange(4 * most), most * rng.randrange(4) + rng.randrange(-2, 13) if most > 2 else 0))) for a in starts]
        rows = [(a, max(a, b)) for a, b in rows]
        assert cut(spark, rows, most) == [loop(a, b, most) for a, b in rows]


def test_reverse_complements(spark):
    s = spark.createDataFrame([("AACCGGTT",), ("acgtN",), ("",), (None,)], "seq string")
    assert [r[0] for r in s.select(q.strict_reverse_complement(F.col("seq"))).collect()] == ["AACCGGTT", "Nacgt", "", None]
    piece = lambda strand: q.extracted(F.col("seq"), F.lit(1), F.lit(5), F.lit(strand))
    assert s.limit(1).select(piece("+"), piece("-")).first()[:] == ("ACCG", "CGGT")
    for bad in (s.limit(1).select(q.extracted(F.col("seq"), F.lit(1), F.lit(9), F.lit("+"))), spark.createDataFrame([("ACR",)], "seq string").select(q.strict_reverse_complement(F.col("seq")))):
        with pytest.raises(Exception, match="interval|base sequence"):
            bad.collect()


def test_site_motifs(spark):
    rows = spark.createDataFrame([("ACGTACGT", 3, a, s) for s, a in (("D", "+"), ("A", "+"), ("D", "-"), ("A", "-"))] + [("AC", 1, "+", "D"), ("AC", 0, "+", "A")], "seq string, pos long, strand string, site string")
    assert [r[0] for r in rows.select(q.site_motif(*(F.col(c) for c in ("seq", "pos", "strand", "site")))).collect()] == ["TA", "GT", "AC", "TA", None, None]


def test_keys_and_records(spark):
    rows = spark.createDataFrame([("scaf_B:907(+)\tD\t0.375\tgc",), ("a\tb",), ("x:1:2(+)\tD\tx\tGT",)], "line string")
    got = [r[0] for r in rows.select(q.parsed_scored_site(F.col("line"))).collect()]
    assert tuple(got[0]) == ("scaf_B", 907, "+", "D", 0.375, "GC") and got[1:] == [None, None]
    head = spark.createDataFrame([("a:b:1-20(+)",), ("a",)], "h string").select(q.parsed_region_header(F.col("h")).alias("x")).collect()
    assert tuple(head[0].x) == ("a:b", 1, 20, "+") and head[1].x.chrom is None
    assert [r[0] for r in spark.createDataFrame([("chr 1/x",), ("",)], "c string").select(q.file_safe(F.col("c"))).collect()] == ["chr_1_x", "unknown"]


def test_pair_counts(spark):
    counts = lambda *seqs: {r.motif: r.n for r in genome.pair_counts(spark.createDataFrame([("c", s) for s in seqs], "chrom string, seq string")).collect()}
    assert counts("AC") == {"AC": 1, "GT": 1} and counts("AT") == {"AT": 2} and counts("", "A", "NN") == {}
    rng = random.Random(1)
    for letters in ("ACGT", "ACGTNacgtn", "ACGTRY"):
        seqs = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(20)]
        want: dict[str, int] = {}
        for s in seqs:
            s = s.upper()
            for p in (s[i : i + 2] for i in range(len(s) - 1)):
                if "N" not in p:
                    for m in (p, p[::-1].translate(str.maketrans("ACGT", "TGCA"))):
                        want[m] = want.get(m, 0) + 1
        assert counts(*seqs) == want


@pytest.mark.parametrize(("chunk", "flank"), [(7, 0), (7, 3), (7, 7), (7, 20), (1000, 5), (1, 4)])
def test_tiles_with_any_flank(spark, chunk, flank):
    rng = random.Random(chunk + flank)
    seqs = {f"c{n}": "".join(rng.choices("ACGTNn", k=n)) for n in (0, 1, 6, 7, 8, 50)}
    g = spark.createDataFrame(list(seqs.items()), "chrom string, seq string")
    got = sorted((r.chrom, r.chunk_index, r.start, r.end, r.flank_start, r.flank_end, r.seq) for r in genome.tiles(g, chunk, flank, 1, n_to_a=False).collect())
    want = []
    for name, s in seqs.items():
        for k, a in enumerate(range(0, len(s), chunk)):
            b = min(a + chunk, len(s))
            lo, hi = max(0, a - flank), min(len(s), b + flank)
            want.append((name, k, a, b, lo, hi, s[lo:hi]))
    assert got == sorted(want)


def test_piles_of_intervals(spark):
    """A hundred thousand intervals with three starts are three rows of their bin."""
    rows = spark.range(100_000).selectExpr("'c' chrom", "'+' strand", "(id % 3) * 50 start", "(id % 3) * 50 + id % 60 `end`")
    assert sorted((r.start, r.end) for r in intervals.merge(rows).collect()) == [(0, 159)]
    assert sorted((r.start, r.end) for r in intervals.merge(rows.filter("id % 60 < 50")).collect()) == [(0, 48), (50, 99), (100, 147)]


def test_tiles(spark):
    g = spark.createDataFrame([("chr1", "ACGTACGT"), ("n", "ACN"), ("e", "")], "chrom string, seq string")
    got = {(r.chrom, r.chunk_index, r.start, r.end, r.strand): r.seq for r in genome.both_strands(genome.tiles(g, 4, 1, 1)).collect()}
    assert got == {("chr1", 0, 0, 4, "+"): "ACGTA", ("chr1", 0, 0, 4, "-"): "ACGTA", ("chr1", 1, 4, 8, "+"): "TACGT", ("chr1", 1, 4, 8, "-"): "TACGT", ("n", 0, 0, 3, "+"): "ACA", ("n", 0, 0, 3, "-"): "ACA"}
    assert {(r.chrom, r.size) for r in genome.sizes(g).collect()} == {("chr1", 8), ("n", 3), ("e", 0)}


def test_lookups(spark):
    g = spark.createDataFrame([("a", "ACGT")], "chrom string, seq string")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "chrom string, x int")
    assert [r.x for r in genome.known_only(rows, g).collect()] == [1] and [r.chrom for r in genome.missing(rows, g).collect()] == ["b"]
    with pytest.raises(Exception, match="no such sequence"):
        genome.cut(rows.selectExpr("chrom", "0L start", "1L `end`"), g).collect()


def test_cuts_over_pieces(spark):
    rng = random.Random(6)
    seqs = {"a": "".join(rng.choices("ACGTN", k=10_000)), "b": "ACG", "e": ""}
    asked = [(c, x, x + rng.randrange(0, 90)) for c in seqs for x in (rng.randrange(-5, len(seqs[c]) + 5) for _ in range(150))] + [("a", 4090, 4100), ("a", 4096, 4196), ("a", 9990, 10_000), ("a", 9990, 10_001)]
    g = spark.createDataFrame(list(seqs.items()), "chrom string, seq string")
    got = genome.cut(spark.createDataFrame(asked, "chrom string, start long, end long"), g, reach=100).collect()
    assert len(got) == len(asked)
    for r in got:
        whole = seqs[r.chrom]
        assert r.seq == (whole[r.start : r.end] if 0 <= r.start and r.end <= len(whole) else None)
    assert "".join(r.piece for r in sorted(genome.pieces(g, 7).filter("chrom = 'a'").collect(), key=lambda r: r.tile)) == seqs["a"]
    with pytest.raises(Exception, match="longer than"):
        genome.cut(spark.createDataFrame([("a", 0, 200)], "chrom string, start long, end long"), g, reach=100).collect()


@pytest.mark.parametrize("touch", [False, True])
def test_merge_is_what_positions_say(spark, touch):
    rng = random.Random(4)
    rows = [("c", "+-"[rng.randrange(2)], a, a + rng.randrange(1, 12)) for a in (rng.randrange(400) for _ in range(120))]
    frame = spark.createDataFrame(rows, "chrom string, strand string, start long, end long")
    want = set()
    for strand in "+-":
        at = None
        for _, _, a, b in sorted(r for r in rows if r[1] == strand):
            if at and (a < at[1] or (touch and a == at[1])):
                at = (at[0], max(at[1], b))
            else:
                want |= {(strand, *at)} if at else set()
                at = (a, b)
        want |= {(strand, *at)} if at else set()
    for width in (7, 1 << 20):
        once = intervals.merge(frame, touch=touch, bin_width=width)
        assert {(r.strand, r.start, r.end) for r in once.collect()} == want
        assert intervals.merge(once, touch=touch).count() == len(want)


TX = "chrom string, tx_start long, tx_end long, name string, strand string, thick_start long, thick_end long, exons array<struct<start:long,end:long>>"


def test_utr_windows_end_to_end(spark):
    g = spark.createDataFrame([("chr1", "ACGTTGCA" * 64)], "chrom string, seq string")
    tx = lambda *rows: spark.createDataFrame([("chr1", s, e, "t", "+", a, b, x) for s, e, a, b, x in rows], TX)
    got = lambda t: sorted((r.start, r.end, len(r.seq), r.strand) for r in pipelines.utr_windows(t, g, 10, 10, 50).collect())
    assert got(tx((100, 260, 120, 200, [(100, 120), (200, 260)]), (150, 320, 170, 250, [(150, 170), (250, 320)]))) == [(190, 240, 50, "+"), (240, 290, 50, "+"), (290, 330, 40, "+")]
    assert got(tx((100, 281, 120, 200, [(100, 281)]))) == [(190, 240, 50, "+"), (240, 291, 51, "+")]
    wide = tx((100, 320, 120, 200, [(100, 120), (200, 320)]), (90, 320, 110, 200, [(90, 100), (130, 150), (200, 320)]))
    assert [x[:2] for x in got(wide)] == [(190, 240), (240, 290), (290, 330)]


def test_bucket_order_is_of_text(spark):
    rows = spark.createDataFrame([("chr1", "+", 1, 2), ("chr10", "+", 1, 2), ("chr1", "-", 1, 2)], "chrom string, strand string, start long, end long")
    placed = ordering.in_order(rows, intervals.bucket_order(rows), "place").collect()
    assert [(r.chrom, r.strand) for r in sorted(placed, key=lambda r: r.place)] == [("chr10", "+"), ("chr1", "+"), ("chr1", "-")]


def test_places_over_many_ranges(spark):
    rows = spark.range(0, 5000).withColumn("v", F.xxhash64("id") % 977).repartition(7)
    got = sorted(ordering.in_order(rows, ["v", "id"], "place").collect(), key=lambda r: r.place)
    assert [r.place for r in got] == list(range(5000)) and [(r.v, r.id) for r in got] == sorted((r.v, r.id) for r in got)


def test_junctions(spark):
    rows = [("c", "007", "60", "+", 1, 0, 3, 1, 10, 0, 0), ("c", "007", "60", "+", 2, 0, 4, 2, 7, 1, 0), ("c", "7", "57", "+", 3, 0, 5, 0, 1, 0, 1), ("c", "7", "56", "+", 3, 0, 9, 0, 1, 0, 2), ("c", "1", "90", "+", 3, 1, 9, 0, 1, 0, 3), ("c", "1", "91", "+", 3, 2, 4, 0, 1, 0, 4)]
    frame = spark.createDataFrame(rows, "chr string, start string, end string, strand string, motif int, annotated int, coverage long, multimap long, overhang long, file_ord int, at long")
    got = sorted((r.start, r.end, r.motif, r.annotated, r.coverage, r.multimap, r.overhang) for r in junctions.merge(frame, ["file_ord", "at"]).collect())
    assert got == [("007", "60", 1, 1, 7, 3, 10), ("7", "57", 3, 1, 5, 0, 1)]


@given(st.text("ACGT", max_size=30))
def test_complement_table_is_an_involution(s):
    t = str.maketrans("ACGT", "TGCA")
    assert s[::-1].translate(t)[::-1].translate(t) == s


def test_pair_counts_of_any_letters(spark):
    rng = random.Random(5)
    rows = [(f"c{k}", "".join(rng.choices("ACGTacgtNnRYx", k=rng.randrange(0, 200)))) for k in range(30)] + [("e", ""), ("n", None), ("long", "ACGTNR" * 2000 + "AAAA")]
    want = {}
    for _, s in rows:
        s = (s or "").upper()
        for pair in map("".join, zip(s, s[1:])):  # noqa: B905
            if "N" not in pair:
                for motif in (pair, pair[::-1].translate(str.maketrans("ACGT", "TGCA"))):
                    want[motif] = want.get(motif, 0) + 1
    frame = spark.createDataFrame(rows, "chrom string, seq string")
    for length in (1 << 14, 7, 1):
        assert {r.motif: r.n for r in genome.pair_counts(frame, length).collect()} == want


@pytest.mark.parametrize("touch", [False, True])
def test_merging_across_bins(spark, touch):
    rng = random.Random(6)
    rows = []
    for chrom in "ab":
        for _ in range(120):
            a = rng.randrange(1500)
            rows.append((chrom, "+", a, a + rng.choice((1, 3, 10, 10, 200))))
    want = []
    for chrom in "ab":
        for _, _, a, b in sorted(r for r in rows if r[0] == chrom):
            if want and want[-1][0] == chrom and (a <= want[-1][3] if touch else a < want[-1][3]):
                want[-1] = (*want[-1][:3], max(b, want[-1][3]))
            else:
                want.append((chrom, "+", a, b))
    frame = spark.createDataFrame(rows, "chrom string, strand string, start long, end long")
    for width in (1 << 20, 16, 100):
        assert sorted(map(tuple, intervals.merge(frame, touch=touch, bin_width=width).select("chrom", "strand", "start", "end").collect())) == want
