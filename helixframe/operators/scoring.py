"""Model scoring: encoders, and injected scorers run over Arrow batches.

A scorer is a function without arguments that gives a function; it is called once per task, so that models are loaded
on executors, when the first batch is there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .genome import cut
from .tracks import WINDOW

CONTEXT = 5000
LIBRARY, LIBRARY_AT = 13, 4


def _mod_rows() -> np.ndarray:
    table = np.arange(256) % 5
    for k, letter in enumerate("NACGT"):
        table[ord(letter)] = k
    return np.vstack([np.zeros(4), np.eye(4)])[table].astype(np.float32)


def _strict_rows() -> np.ndarray:
    table = np.zeros((256, 4), dtype=np.float32)
    for k, letter in enumerate("ACGT"):
        table[ord(letter), k] = 1
    return table


_MOD_ROWS, _STRICT_ROWS = _mod_rows(), _strict_rows()


def one_hot_mod(seq: str) -> np.ndarray:
    """(L, 4): A, C, G, T are 1 to 4 and N is 0, all-zero; any other byte counts as its value modulo 5."""
    return _MOD_ROWS[np.frombuffer(seq.upper().encode("latin-1"), dtype=np.uint8)]


def one_hot_strict(seq: str) -> np.ndarray:
    """(L, 4): rows of upper-case A, C, G, T; all-zero for anything else."""
    return _STRICT_ROWS[np.frombuffer(seq.encode("latin-1", "replace"), dtype=np.uint8)]


def window_inputs(windows: list[str], length: int = WINDOW, library: int = LIBRARY, at: int | None = LIBRARY_AT, channels_last: bool = True) -> list[np.ndarray]:
    """What a window model takes: one-hot rows, a library vector (all zero if `at` is None) and ones.

    channels_last: (n, length, 4, 1), else (n, 1, length, 4), as older models of windows of 185 and 36 libraries want.
    """
    if bad := [len(w) for w in windows if len(w) != length]:
        raise ValueError(f"windows must have {length} bases, not {bad[0]}")
    x = one_hot_strict("".join(windows)).reshape(len(windows), length, 4)
    libraries = np.zeros((len(windows), library), dtype=np.float32)
    if at is not None:
        libraries[:, at] = 1
    return [x[..., None] if channels_last else x[:, None], libraries, np.ones((len(windows), 1), dtype=np.float32)]


def pair_inputs(sites: pd.DataFrame) -> list[np.ndarray]:
    """What a pairwise model takes of rows with proximal, distal (windows), their cut starts and ends, and distance: nine arrays, the distance as its log."""
    near, library, ones = window_inputs(list(sites["proximal"]), at=None)
    far = window_inputs(list(sites["distal"]), at=None)[0]
    column = lambda c: sites[c].to_numpy(dtype=float)[:, None]
    return [near, far, *(column(c) for c in ("proximal_start", "proximal_end", "distal_start", "distal_end")), np.log(column("distance")), library, ones]


#: Bases that a model gets at once, context included; a longer sequence comes alone.
CALL_BASES = 1 << 20
#: Windows that a model gets at once.
CALL_WINDOWS = 1 << 11


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list array of arrays."""
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values), kind))


def _loaded(kept: Broadcast, scorer: Callable[[], Callable]) -> Callable:
    """The model, loaded once a worker: its tasks have one value of a broadcast (an empty table), which keeps it."""
    if "model" not in kept.value:
        kept.value["model"] = scorer()
    return kept.value["model"]


def calls(lengths: list[int], most: int = CALL_BASES) -> list[list[int]]:
    """Places of sequences that go to a model together: equally long ones, at most `most` bases unless it is one."""
    by_length: dict[int, list[int]] = {}
    for k, n in enumerate(lengths):
        by_length.setdefault(n, []).append(k)
    return [own[a : a + step] for n, own in sorted(by_length.items()) for step in [max(1, most // max(n, 1))] for a in range(0, len(own), step)]


def score_sites(chunks: DataFrame, scorer: Callable[[], Callable[[np.ndarray], np.ndarray]], context: int = CONTEXT, keep: tuple[str, ...] = (), call_bases: int = CALL_BASES) -> DataFrame:
    """chrom, start, end, strand, the columns `keep` (longs), acceptor and donor (arrays, one value a base of seq).

    The model gets (n, L + 2 * context, 4) and gives (n, L, 3): nothing, acceptor, donor. Records of a task are sorted by
    length, and equally long ones (chunks of a genome are, but for the last of a contig) go to it in one call, whose values
    leave the task before the next call is made. It is loaded once a worker and not once a task. Models of an ensemble are averaged by the scorer that is given (see `ensemble`).
    """
    more = "".join(f"`{c}` long, " for c in keep)
    schema = f"chrom string, start long, end long, strand string, {more}acceptor array<float>, donor array<float>"
    kept = chunks.sparkSession.sparkContext.broadcast({})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = _loaded(kept, scorer)
        for b in batches:
            seqs, others = b.column("seq").to_pylist(), b.select(["chrom", "start", "end", "strand", *keep])
            for own in calls([len(s) + 2 * context for s in seqs], call_bases):
                made = predict(np.stack([one_hot_mod("N" * context + seqs[k] + "N" * context) for k in own]))
                values = [_lists([y[:, k] for y in made], pa.float32()) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays([*others.take(pa.array(own)).columns, *values], names=[*others.schema.names, "acceptor", "donor"])
                del made, values

    rows = chunks.selectExpr("chrom", "cast(start as long) start", "cast(`end` as long) `end`", "strand", "seq", *[f"cast(`{c}` as long) `{c}`" for c in keep])
    return rows.sortWithinPartitions(F.length("seq")).mapInArrow(run, schema)


def ensemble(scorers: list[Callable[[], Callable]]) -> Callable[[], Callable]:
    """One scorer that gives the mean of several."""

    def load():
        models = [s() for s in scorers]
        return lambda x: np.mean([m(x) for m in models], axis=0)

    return load


def models_from(paths: list[str], load: Callable[[str], Callable]) -> Callable[[], Callable]:
    """One scorer of the models at `paths`, each loaded by `load` once a worker; a path that isn't there is an error on the driver."""
    if lacking := [p for p in paths if not Path(p).exists()]:
        raise FileNotFoundError(f"no model at {', '.join(lacking)}")
    if not paths:
        raise ValueError("no models")
    return ensemble([partial(load, p) for p in paths])


def score_windows(windows: DataFrame, scorer: Callable[[], Callable], key: str = "seq_id", near: tuple[int, int] | None = None) -> DataFrame:
    """`key`, window_start, iso and cuts (array, one value a base) of each window; what the model gives for `none` is dropped.

    The model gets [(n, 205, 4, 1), (n, 13), (n, 1)], at most CALL_WINDOWS windows, and gives iso (n, 1) and cuts (n, 206). With
    `near` (a place from 0, and how many) there is only the sum of those cuts, as `near`, and not all of them.
    """
    schema = f"`{key}` string, window_start int, iso double, " + ("cuts array<double>" if near is None else "near double")
    kept = windows.sparkSession.sparkContext.broadcast({})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = _loaded(kept, scorer)
        for whole in batches:
            for at in range(0, whole.num_rows, CALL_WINDOWS):
                b = whole.slice(at, CALL_WINDOWS)
                iso, cuts = predict(window_inputs(b.column("window").to_pylist()))
                cuts = np.asarray(cuts)[:, :WINDOW].astype(float)
                if near is None:
                    made = _lists(list(cuts), pa.float64())
                else:  # from the first to the last, as a loop would
                    made = pa.array(reduce(np.add, cuts[:, near[0] : near[0] + near[1]].T, np.zeros(len(cuts))))
                yield pa.RecordBatch.from_arrays([b.column(key), b.column("window_start"), pa.array(iso[:, 0].astype(float)), made], names=[key, "window_start", "iso", "cuts" if near is None else "near"])

    return windows.selectExpr(f"cast(`{key}` as string) `{key}`", "cast(window_start as int) window_start", "window").mapInArrow(run, schema)


#: The cuts next to a peak, as places from 0 in a window, and how many.
NEAR = 77, 30


def peak_windows(peaks: DataFrame, seqs: DataFrame, key: str = "chrom", stride: int = 2, reach: int = 30, left: int = 80, pad: int = 35) -> DataFrame:
    """`peaks` (`key` and peak, a position) with the windows around each, one a stride further left, as window_start and window.

    Peaks near an end of their sequence (`key` and seq of `seqs`) have none; beyond the ends letters are X. Each peak meets the
    one piece of its sequence that it is in, so that no row carries a sequence.
    """
    whole = seqs.select(F.col(key).alias("chrom"), "seq")
    sizes = whole.select(F.col("chrom").alias("_of"), F.length("seq").cast("bigint").alias("_n"))
    at, first = F.col("peak").cast("bigint"), F.col("peak").cast("bigint") - left - (reach - stride)
    inner = peaks.join(sizes, F.col(key) == F.col("_of")).filter((at > 75) & (at < F.col("_n") - 150))
    named = inner if key == "chrom" else inner.withColumn("chrom", F.col(key))
    found = cut(named.withColumn("_lo", F.greatest(first, F.lit(0))).withColumn("_hi", F.least(at - left + WINDOW, F.col("_n"))), whole, "_lo", "_hi", "_near", reach=WINDOW + reach)
    # dealt to all tasks before there are many windows of each: the joins may leave them where the sequences were read
    rows = found.repartition(*peaks.columns).withColumn("window_start", F.explode(F.sequence(first, at - left, F.lit(stride).cast("bigint"))))
    padded = F.concat(F.repeat(F.lit("X"), F.lit(pad)), "_near", F.repeat(F.lit("X"), F.lit(pad)))
    window = F.substring(padded, (F.col("window_start") - F.col("_lo") + pad + 1).cast("int"), F.lit(WINDOW))
    kept = rows.withColumn("window", window).filter((F.col("window_start") + pad >= 0) & (F.length("window") == WINDOW))
    return kept.select(*peaks.columns, F.col("window_start").cast("int").alias("window_start"), "window")


def _median(column: str) -> Column:
    """The middle value, or the mean of the two, of the few values of a group: they are sorted, and not counted by value."""
    v = F.array_sort(F.collect_list(column))
    low, high = F.get(v, F.floor((F.size(v) - 1) / 2).cast("int")), F.get(v, F.floor(F.size(v) / 2).cast("int"))
    return 0.5 * low + 0.5 * high


def peak_scores(scored: DataFrame, peaks: DataFrame, by: list[str], aggregate: str = "max", mode: str = "both", unit: str = "log", none: float = -10.0) -> DataFrame:
    """`by` and peak_score of every row of `peaks`, from iso and cuts (or near, the sum of those at NEAR) of its windows; `none` where it has none."""
    pick = {"max": F.max, "mean": F.avg, "median": _median}[aggregate]
    near = F.col("near") if "near" in scored.columns else F.aggregate(F.slice("cuts", NEAR[0] + 1, NEAR[1]), F.lit(0.0), lambda a, x: a + x)
    what = {"both": ("iso", "_near"), "from_iso": ("iso",), "from_cuts": ("_near",)}[mode]
    found = scored.withColumn("_near", near).groupBy(*by).agg(*[pick(c).alias({"iso": "_iso", "_near": "_cuts"}[c]) for c in what])
    value = (F.col("_iso") + F.col("_cuts")) / 2 if mode == "both" else F.col("_iso" if mode == "from_iso" else "_cuts")
    value = F.ln(value / (1 - value)) if unit == "log" else value
    return peaks.select(*by).join(found, by, "left").select(*by, F.coalesce(F.bround(value, 3), F.lit(none)).alias("peak_score"))


def composition_scorer() -> Callable[[list[np.ndarray]], tuple[np.ndarray, np.ndarray]]:
    """A stand-in for a model, without weights: the share of A and T around each base."""

    def predict(inputs):
        at = inputs[0][:, :, (0, 3), 0].sum(2, dtype=float)
        cuts = np.concatenate([at, 1 - at.mean(1, keepdims=True)], axis=1)
        return at.mean(1, keepdims=True), cuts / np.maximum(cuts.sum(1, keepdims=True), 1e-9)

    return predict
