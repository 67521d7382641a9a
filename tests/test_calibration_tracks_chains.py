import math
import random
import time
import weakref

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helixframe.operators import annotation, calibration as c, chains, genome, peaks, scoring, tracks
from helixframe.plans import pipelines

SITES = "chrom string, pos long, strand string, site string, score float, motif string"


def test_bins_of_scores(spark):
    rng = random.Random(12)
    edges = [np.float32(e) for e in c.EDGES]
    near = [float(np.nextafter(e, np.float32(way))) for e in edges for way in (-9, 9)]
    rows = [*map(float, edges), *near, *(float(np.float32(rng.random())) for _ in range(200)), float("nan"), 7.5, -3.25]
    want = [13 if x != x else max(0, min(13, sum(np.float32(x) >= e for e in edges) - 1)) for x in rows]
    got = [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k int, score float").select("k", c.score_bin(F.col("score")).alias("b")).orderBy("k").select("b").collect()]
    assert got == want
    assert c.scored(spark.createDataFrame([(x,) for x in rows], "score float")).count() == sum(x == x and np.float32(x) >= np.float32(0.001) for x in rows)


def test_derived_scores(spark):
    rng = random.Random(13)
    cases = [(p, x, lo, lo + rng.randrange(0, 25)) for p in (0.0, 1.0, rng.random(), rng.random() / 999) for x in (0.0, 1.0, rng.random(), rng.random() / 999) for lo in (-6, 0)]
    for p, x, lo, hi in cases:
        raw = 0 if p == 0 or x == 0 else 2 * math.log2(p / x)
        want = lo if p == 0 else hi if x == 0 else max(lo, min(hi, int(math.copysign(math.floor(abs(raw) + 0.5), raw))))
        assert spark.range(1).select(c.derived_score(F.lit(p), F.lit(x), lo, hi)).first()[0] == want
    with pytest.raises(ValueError):
        c.derived_score(F.lit(0.5), F.lit(0.5), 4, 3)


def test_zero_bin_is_filled_up(spark):
    sites = spark.createDataFrame([("chr1", 10, "+", "D", 0.98, "GT"), ("chr1", 20, "+", "D", 0.2, "GT")], SITES)
    known = spark.createDataFrame([("chr1", 10, "+"), ("chr1", 30, "+")], "chrom string, pos long, strand string")
    counts = lambda n: spark.createDataFrame([("GT", n)], "motif string, n long")
    got = {r.bin: (r.n_total, r.n_real) for r in c.bins(c.flagged(sites, known), counts(5), counts(2)).collect()}
    assert len(got) == 14 and got[0] == (3, 1) and got[10] == (1, 1) and got[4] == (1, 0) and sum(t for t, _ in got.values()) == 5


def test_shifts_null_profile_and_distinct_motifs(spark):
    rows = spark.createDataFrame([(19, s, k) for s in "+-" for k in "DA"], "pos long, strand string, site string")
    assert [r[0] for r in rows.select(c.shifted(F.col("pos"), F.col("strand"), F.col("site"))).collect()] == [19, 20, 20, 19]
    g, a = (spark.createDataFrame(x, "motif string, n long") for x in ([("GT", 4), ("AA", 2)], [("GT", 1), ("ZZ", 3)]))
    assert {r.motif: r.p_null for r in c.null_profile(g, a).collect()} == {"GT": 0.25, "AA": 0.0, "ZZ": 0.0}


def test_annotated_sites(spark):
    seq = "".join(random.Random(0).choices("ACGT", k=40))
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    tx = spark.createDataFrame([("c", s, [(0, 10), (20, 30)]) for s in ("+", "-", ".")], "chrom string, strand string, exons array<struct<start:long,end:long>>")
    got = {(r.strand, r.site): (r.pos, r.motif) for r in annotation.splice_sites(tx, spark.createDataFrame([("c", seq)], "chrom string, seq string")).collect()}
    assert got[("+", "D")] == (10, seq[10:12]) and got[("+", "A")] == (19, seq[18:20]) and got[("-", "D")] == (20, rc(seq[18:20])) and got[("-", "A")] == (10, rc(seq[10:12])) and got[(".", "D")] == got[("+", "D")]


def test_sliding_windows(spark):
    sizes = [1, 10, 205, 206, 215, 216]
    rows = spark.createDataFrame([(n, "A" * n) for n in [0, *sizes]], "n int, seq string")
    got = tracks.sliding_windows(rows)
    assert {r.n: r["count"] for r in got.groupBy("n").count().collect()} == dict(zip(sizes, [1, 1, 1, 2, 2, 3], strict=True))
    assert got.filter(F.length("window") != 205).count() == 0 and got.filter("n = 206 and window_start = 10").first().window == "A" * 196 + "X" * 9


def test_windows_of_long_sequences_take_time_in_proportion(spark):
    """20 million letters in one row: all windows, and those around peaks, are where they belong."""
    n = 20_000_000
    seqs = spark.range(1).select(F.lit("c").alias("chrom"), F.repeat(F.lit("ACGTTGCATT"), F.lit(n // 10)).alias("seq"))
    began = time.time()
    got = tracks.sliding_windows(seqs).agg(F.count(F.lit(1)).alias("n"), F.max("window_start").alias("last"), F.count_if(F.col("window") == "ACGTTGCATT" * 20 + "ACGTT").alias("same")).first()
    assert (got.n, got.last, got.same) == ((n - 205 + 9) // 10 + 1, n - 200, got.n - 1)
    peaks = spark.range(0, n, 100_000).select(F.lit("c").alias("chrom"), F.col("id").alias("peak"))
    found = scoring.peak_windows(peaks, seqs)
    assert found.count() == 199 * 15 and found.filter(~F.col("window").startswith(F.lit("ACGTTGCATTACGTTGCATT"))).filter("window_start % 10 = 0").count() == 0
    assert time.time() - began < 120


def test_models_get_equally_long_records_at_once_and_are_loaded_once_a_worker(spark, tmp_path):
    log = tmp_path / "log"

    def scorer():
        with open(log, "a") as f:
            f.write("load\n")

        def predict(x):
            with open(log, "a") as f:
                f.write(f"{x.shape[0]} {x.shape[1]}\n")
            return np.stack([x[:, 2:-2].sum(2), np.cumsum(x[:, 2:-2, 0], 1), x[:, 2:-2, 3]], axis=2)

        return predict

    rows = [("c", k, k + n, "+", "ACGTN"[k % 5] + "A" * (n - 1)) for k, n in enumerate([40] * 30 + [17, 17, 9])]
    chunks = spark.createDataFrame(rows, "chrom string, start long, end long, strand string, seq string").repartition(1)
    got = {r.start: list(r.acceptor) for r in scoring.score_sites(chunks, scorer, context=2).collect()}
    assert got == {k: list(np.cumsum([x == "A" for x in s])) for _, k, _, _, s in rows}
    assert sorted(x for x in log.read_text().split("\n") if x not in ("", "load")) == ["1 13", "2 21", "30 44"]
    log.unlink()
    scoring.score_sites(chunks, scorer, context=2, call_bases=100).collect()
    assert len([x for x in log.read_text().split("\n") if x.endswith(" 44")]) == 15
    log.unlink()
    scoring.score_sites(chunks.repartition(20), scorer, context=2).collect()
    assert log.read_text().split("\n").count("load") <= 4  # of twenty tasks in four workers


def test_intervals_of_any_length(spark):
    rng = random.Random(7)
    seqs = {"a": "".join(rng.choices("ACGTN", k=30_000)), "b": "ACG", "e": ""}
    g = spark.createDataFrame(list(seqs.items()), "chrom string, seq string")
    asked = [("a", s, e) for s, e in ((0, 30_000), (0, 1), (29_999, 30_000), (4095, 4097), (4096, 12_288), (5, 29_990), (100, 4196), (100, 4197), (-1, 9000), (9, 30_001), (20_000, 40_000))] + [("b", 0, 3), ("b", 0, 9000), ("e", 0, 0)]
    got = genome.cut_any(spark.createDataFrame([*asked, asked[0]], "chrom string, start long, end long"), g).collect()
    assert sorted(((r.chrom, r.start, r.end), r.seq) for r in got if r.seq is not None) == sorted(((c, s, e), seqs[c][s:e]) for c, s, e in [*asked, asked[0]] if 0 <= s and e <= len(seqs[c]))
    assert len(got) == 15
    with pytest.raises(Exception, match="no such sequence"):
        genome.cut_any(spark.createDataFrame([("z", 0, 9000)], "chrom string, start long, end long"), g).collect()


def test_positions_along_long_chains(spark):
    rng = random.Random(8)
    rows = [(c, k, rng.randrange(9), rng.randrange(5), None if k == n - 1 else rng.randrange(7)) for c, n in ((1, 1), (2, 64), (3, 65), (4, 500)) for k in range(n)]
    blocks = spark.createDataFrame(rows, BLOCKS)
    want = sorted(map(tuple, chains.coordinates(blocks).collect()))
    assert sorted(map(tuple, chains.coordinates(blocks, bin=32).collect())) == want
    t = 0
    for r in [r for r in want if r[0] == 4]:
        assert r[5] == t
        t += r[2] + r[3]


def test_profile_lines(spark):
    rows = spark.createDataFrame([("c", 100, 103, s, [0.5, 0.0, 0.7]) for s in "+-"], "chrom string, start long, end long, strand string, profile array<double>")
    got = {s: [(r.line_start, r.line_end, r.value, r.name) for r in tracks.profile_lines(rows.filter(F.col("strand") == s)).collect()] for s in "+-"}
    assert got == {"+": [(99, 100, 0.5, "peak_0"), (101, 102, 0.7, "peak_2")], "-": [(100, 101, 0.7, "peak_0"), (102, 103, 0.5, "peak_2")]}


def test_smoothing_and_overlap_add_against_numpy(spark):
    rng = np.random.default_rng(0)
    n, starts = 30, [0, 10, 15]
    preds = rng.random((len(starts), 15))
    whole, cover = np.zeros(n), np.zeros(n)
    for s, p in zip(starts, preds, strict=True):
        whole[s : s + 15] += p
        cover[s : s + 15] += 1
    want = np.convolve(whole, tracks.KERNEL, mode="same") / cover
    flat = spark.createDataFrame([("x", s + i, float(v)) for s, p in zip(starts, preds, strict=True) for i, v in enumerate(p)], "seq_id string, pos long, value double")
    for tile in (1 << 16, 7):
        got = tracks.smoothed(tracks.overlap_add(flat), "total", "smooth", tile=tile).select("pos", (F.col("smooth") / F.col("coverage")).alias("v")).orderBy("pos").collect()
        assert np.allclose([r.v for r in got], want)


def test_floor_flanks_and_core(spark):
    vals = spark.createDataFrame([(0.0009,), (0.001,), (float(np.float32(0.12345)),)], "p double")
    assert [r[0] for r in vals.select(tracks.floored(F.col("p"), 0.001, 4)).collect()] == [0.0, 0.001, round(float(np.float32(0.12345)), 4)]
    f = spark.range(1).select(tracks.flanks(F.lit(0).cast("long"), F.lit(4).cast("long"), F.lit(5).cast("long"), 1).alias("f")).first().f
    assert tuple(f) == (0, 1)
    arr = F.array(*[F.lit(k) for k in range(5)])
    core = lambda s: tracks.core(arr, F.lit(0), F.lit(1), F.lit(s))
    assert spark.range(1).select(core("+"), core("-")).first()[:] == ([0, 1, 2, 3], [4, 3, 2, 1])


def test_peaks():
    x = np.zeros(40)
    x[[5, 7, 20, 30]] = [0.5, 0.6, 0.3, 0.005]
    x[12:15] = 0.2
    assert peaks.find_peaks(x) == [7, 13, 20]


BLOCKS = "chain_id long, block_no int, size long, dt long, dq long"


def test_gap_ranges_and_coordinates(spark):
    rows = spark.createDataFrame([(1, k, 5, t, q) for k, (t, q) in enumerate([(10, 10), (9, 10), (100000, 100000), (100001, 10), (None, None)])], BLOCKS)
    assert sorted(r.block_no for r in chains.gaps(rows).collect()) == [0, 2]
    placed = sorted(chains.coordinates(rows).collect(), key=lambda r: r.block_no)
    assert [r.t_pos for r in placed] == [0, 15, 29, 100034, 200040] and [r.q_pos for r in placed] == [0, 15, 30, 100035, 100050]


def test_patch(spark):
    rows = spark.createDataFrame([(1, 0, 30, 50, 40, 70, 170), (1, 1, 9, None, None, 150, 240)], BLOCKS + ", t_pos long, q_pos long")
    patch = spark.createDataFrame([(1, 0, 0, 5000, 110, 140, 205, 235, [(30, None, None)]), (1, 0, 1, 9000, 0, 0, 0, 0, [(1, None, None)])], "chain_id long, block_no int, rank int, score long, t_start long, t_end long, q_start long, q_end long, blocks array<struct<size:long,dt:long,dq:long>>")
    got = sorted(tuple(r) for r in chains.patched(rows, chains.best_patches(patch)).collect())
    assert [r[3:] for r in got] == [(30, 10, 5), (30, 10, 5), (9, None, None)]
    assert chains.best_patches(patch, 6000).count() == 0


def test_encoders():
    assert scoring.one_hot_mod("ACGTNR").argmax(1).tolist() == [0, 1, 2, 3, 0, 1] and scoring.one_hot_mod("N").sum() == 0
    assert scoring.one_hot_strict("AcX").sum(1).tolist() == [1, 0, 0]
    x, library, ones = scoring.window_inputs(["A" * 205] * 2)
    assert x.shape == (2, 205, 4, 1) and library.shape == (2, 13) and library[0].argmax() == 4 and ones.shape == (2, 1)
    old = scoring.window_inputs(["A" * 185], 185, 36, None, channels_last=False)
    assert old[0].shape == (1, 1, 185, 4) and old[1].shape == (1, 36) and not old[1].any()
    pair = scoring.pair_inputs(pd.DataFrame([{"proximal": "A" * 205, "distal": "C" * 205, "proximal_start": 1, "proximal_end": 2, "distal_start": 3, "distal_end": 4, "distance": 7}]))
    assert len(pair) == 9 and pair[6][0, 0] == math.log(7) and pair[7].shape == (1, 13)
    with pytest.raises(ValueError):
        scoring.window_inputs(["A"])


def test_scoring(spark):
    def scorer():
        return lambda x: np.stack([x[:, 2:-2].sum(2), x[:, 2:-2, 0], x[:, 2:-2, 3]], axis=2)

    chunks = spark.createDataFrame([("c", 0, 4, "+", "ACGT")], "chrom string, start long, end long, strand string, seq string")
    r = scoring.score_sites(chunks, scoring.ensemble([scorer, scorer]), context=2).first()
    assert r.acceptor == [1, 0, 0, 0] and r.donor == [0, 0, 0, 1]
    rows = spark.createDataFrame([("c", 100, 400, s, "ACGTT" * 60) for s in "+-"], "chrom string, start long, end long, strand string, seq string")
    made = pipelines.polya_profiles(rows, scoring.composition_scorer).collect()
    assert len(made) == 2 and all(len(r.profile) == 300 for r in made)
    peaks = spark.createDataFrame([("c", 120), ("c", 20)], "seq_id string, peak int")
    windows = scoring.peak_windows(peaks, spark.createDataFrame([("c", "ACGTT" * 60)], "seq_id string, seq string"), "seq_id")
    assert windows.count() == 15 and windows.filter("window_start < 0 and window like 'X%'").count() == 0
    keyed = windows.withColumn("seq_id", F.concat_ws("|", "seq_id", "peak"))
    wanted = peaks.withColumn("seq_id", F.concat_ws("|", "seq_id", "peak"))
    got = {r.seq_id: r.peak_score for r in scoring.peak_scores(scoring.score_windows(keyed, scoring.composition_scorer), wanted, ["seq_id"]).collect()}
    assert got["c|20"] == -10 and got["c|120"] > -10


def test_windows_are_dealt_to_all_tasks_and_models_get_them_by_parts(spark):
    seqs = spark.createDataFrame([("c", "ACGT" * 20_000)], "chrom string, seq string").coalesce(1)
    most = scoring.CALL_WINDOWS

    def scorer():
        def predict(inputs):
            assert len(inputs[0]) <= most
            return scoring.composition_scorer()(inputs)

        return predict

    peaks = seqs.select("chrom", F.explode(F.sequence(F.lit(0), F.lit(80_000), F.lit(100))).alias("peak"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for windows in (tracks.sliding_windows(seqs), scoring.peak_windows(peaks, seqs)):
            assert windows.select(F.spark_partition_id()).distinct().count() == 4
        one = scoring.peak_windows(peaks, seqs).coalesce(1)
        summed = scoring.score_windows(one, scorer, "chrom", near=scoring.NEAR).agg(F.sum("near")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    whole = scoring.score_windows(one, scorer, "chrom").select(F.explode(F.slice("cuts", 78, 30)).alias("c")).agg(F.sum("c")).first()[0]
    assert abs(summed - whole) < 1e-9 * whole


def test_what_a_model_gave_is_gone_before_its_next_call(spark):
    def scorer():
        last = []

        def predict(x):
            assert not last or last.pop()() is None
            made = np.stack([x[:, 2:-2].sum(2)] * 3, axis=2)
            last.append(weakref.ref(made))
            return made

        return predict

    chunks = spark.range(400).selectExpr("'c' chrom", "id start", "id + 50 `end`", "'+' strand", "repeat('A', 50) seq").coalesce(1)
    assert scoring.score_sites(chunks, scorer, context=2, call_bases=1000).selectExpr("sum(size(acceptor)) n").first().n == 400 * 50


def test_medians_of_even_odd_and_no_values(spark):
    rows = spark.createDataFrame([("a", 0.25), ("a", 0.5), ("b", 0.1), ("b", 0.7), ("b", 0.3), ("c", None)], "k string, iso double").withColumn("near", F.col("iso"))
    made = scoring.peak_scores(rows, rows.select("k").distinct(), ["k"], "median", "from_iso", "probability")
    assert {r.k: r.peak_score for r in made.collect()} == {"a": 0.375, "b": 0.3, "c": -10.0}
