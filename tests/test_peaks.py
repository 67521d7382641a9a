"""Peaks in linear time against a plain search, and in tiles against the whole."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import peaks as p


def plain(x, height=p.HEIGHT, distance=p.DISTANCE, prominence=p.PROMINENCE):
    """By the definition, place by place."""
    n, tops, i = len(x), [], 1
    while i < n - 1:
        j = i
        while j + 1 < n and x[j + 1] == x[i]:
            j += 1
        if x[i - 1] < x[i] and j + 1 < n and x[j + 1] < x[i] and x[i] >= height:
            tops.append((i + j) // 2)
        i = j + 1
    left, kept = sorted(tops, key=lambda k: (x[k], k)), []
    while left:
        top = left.pop()
        kept.append(top)
        left = [k for k in left if abs(k - top) >= distance]

    def low(k, step):
        least, m = x[k], k
        while 0 <= m < n and x[m] <= x[k]:
            least, m = min(least, x[m]), m + step
        return least

    return sorted(k for k in kept if x[k] - max(low(k, -1), low(k, 1)) >= prominence)


def profiles(rng):
    for n in (0, 1, 2, 3, 5, 64, 300):
        yield [rng.random() for _ in range(n)]
        yield [rng.choice([0.0, 0.25, 0.5, 1.0]) for _ in range(n)]
    yield [0.0] + [0.7] * 200 + [0.1]  # one plateau
    yield [k % 2 * (1 + k / 100) for k in range(200)]  # ever higher peaks, two apart
    yield [k % 2 * (3 - k / 100) for k in range(200)]
    yield [1.0, *([0.5, 0.6] * 80), 1.0, 0.2, 0.9, *([0.3] * 70)]
    yield [float(abs(50 - k % 100)) for k in range(500)]
    yield [0.5] * 90


LIMITS = [{}, {"distance": 1, "prominence": 0.0}, {"distance": 5, "height": 0.3}, {"distance": 40, "prominence": 0.2}]


@pytest.mark.parametrize("limits", LIMITS)
def test_arrays(limits):
    for x in profiles(random.Random(2)):
        assert p.find_peaks(np.array(x), **limits) == plain(x, **limits)


def test_linear_time():
    x = np.random.default_rng(3).random(300_000)
    began = time.time()
    assert len(p.find_peaks(x)) > 10_000 and len(p.find_peaks(np.arange(300_000) % 2 * np.linspace(1, 2, 300_000), distance=50)) > 0
    assert time.time() - began < 20


@pytest.mark.parametrize("limits", [{"tile": 7, "halo": 2}, {"tile": 50, "distance": 5, "height": 0.3, "halo": 6}, {"tile": 16, "distance": 40, "prominence": 0.2}])
def test_tiles_equal_the_whole(spark, limits):
    made = dict(enumerate(profiles(random.Random(4)), 1))
    rows = spark.createDataFrame([(k, i + 1000 * k, v) for k, x in made.items() for i, v in enumerate(x)], "seq_id long, pos long, value double").repartition(5)
    got = {}
    for r in p.tiled_peaks(rows, **limits).collect():
        got.setdefault(r.seq_id, []).append(r.peak - 1000 * r.seq_id)
    own = {k: v for k, v in limits.items() if k not in ("tile", "halo")}
    assert {k: sorted(v) for k, v in got.items()} == {k: w for k, x in made.items() if (w := plain(x, **own))}


def test_gaps_are_an_error_and_null_keys_are_a_profile(spark):
    rows = spark.createDataFrame([("a", k, float(k % 3)) for k in range(40)] + [(None, k, float(k % 5)) for k in range(40)], "seq_id string, pos long, value double")
    got = sorted((r.seq_id or "", r.peak) for r in p.tiled_peaks(rows, tile=8).collect())
    assert got == sorted([("a", k) for k in plain([float(k % 3) for k in range(40)])] + [("", k) for k in plain([float(k % 5) for k in range(40)])])
    for bad in (rows.filter("pos <> 9"), rows.filter("pos <> 8"), rows.withColumn("value", F.when(F.col("pos") != 9, F.col("value")))):
        with pytest.raises(Exception, match="consecutive"):
            p.tiled_peaks(bad, tile=8).collect()
    assert p.tiled_peaks(rows.filter("pos < 0")).collect() == []


def test_ten_million_positions(spark):
    """One profile of sines and a hash, too long for any one row to be handy: tiles against the whole array."""
    n = 10_000_000
    rows = spark.range(0, n, 1, 8).select(F.lit(1).cast("long").alias("seq_id"), F.col("id").alias("pos"), (F.abs(F.sin(F.col("id") / 90_000.0)) + (F.col("id") * 7919 % 1009) / 4000.0).alias("value"))
    at = np.arange(n, dtype=np.int64)
    x = np.array(rows.select("value").toPandas()["value"])
    assert len(x) == n and at[-1] == n - 1
    limits = {"distance": 60, "prominence": 0.1}
    got = np.sort(p.tiled_peaks(rows, **limits).toPandas()["peak"].to_numpy())
    assert len(got) > 1000 and got.tolist() == p.find_peaks(x, **limits)


def test_many_profiles_have_more_tiles_than_one_may(spark, monkeypatch):
    monkeypatch.setattr(p, "MOST_TILES", 8)
    rows = spark.range(30).selectExpr("id seq_id", "explode(sequence(0, 31)) pos").selectExpr("seq_id", "pos", "cast((pos * 7 + seq_id) % 11 as double) value")
    got = {tuple(r) for r in p.tiled_peaks(rows, tile=8).collect()}
    want = {(k, at) for k in range(30) for at in p.find_peaks(np.array([(x * 7 + k) % 11 for x in range(32)], float))}
    assert got == want
