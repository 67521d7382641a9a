"""Peaks of profiles: of one array in linear time, and of profiles of any length in tiles.

A peak is the middle of a plateau that is higher than both neighbours, at least `height` high. Of two nearer than
`distance` the higher one stays (of equal ones the later), from the highest peak down. Then those stay whose height over
the higher of their two lows is at least `prominence`; a low is the least value up to what is strictly higher on a side.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import checkpointed, small

HEIGHT, DISTANCE, PROMINENCE = 0.001, 3, 0.01
TILE = 1 << 16
#: Tiles that one profile may have; more are an error: take larger tiles.
MOST_TILES = 1 << 21


def plateaus(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of equal values."""
    edge = np.flatnonzero(x[1:] != x[:-1]) + 1 if len(x) else np.empty(0, int)
    first = np.concatenate(([0], edge)) if len(x) else edge
    return first, np.concatenate((edge, [len(x)]))[: len(first)] - 1


def maxima(x: np.ndarray) -> np.ndarray:
    """Middles of the inner plateaus that are higher than both neighbours."""
    first, last = plateaus(x)
    v = x[first]
    top = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1 if len(v) > 2 else np.empty(0, int)
    return (first[top] + last[top]) // 2


def apart(pos: np.ndarray, height: np.ndarray, distance: int, lo: float = -np.inf, hi: float = np.inf) -> np.ndarray:
    """What becomes of each peak (by ascending position): 1 stays, 0 goes, -1 can't be told from peaks in [lo, hi) alone."""
    state = np.full(len(pos), 2)  # 2: not looked at yet, 3: that too, but a higher one near it can't be told
    unseen = (pos - lo < distance) | (hi - 1 - pos < distance)
    for k in np.lexsort((pos, height))[::-1]:
        if state[k] == 0:
            continue
        state[k] = -1 if unseen[k] or state[k] == 3 else 1
        for step in (-1, 1):
            n = k + step
            while 0 <= n < len(pos) and abs(pos[n] - pos[k]) < distance:
                if state[n] > 1:
                    state[n] = 0 if state[k] == 1 else 3
                n += step
    return state


def lows(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least value from each of these places to the left, up to what is strictly higher, and whether nothing is."""
    low, free = np.empty(len(x)), np.empty(len(x), bool)
    walls: list[tuple[float, float]] = []  # ever lower values, each with the least since the one before it
    for i, a in enumerate(x.tolist()):
        least = a
        while walls and walls[-1][0] <= a:
            least = min(least, walls.pop()[1])
        low[i], free[i] = least, not walls
        walls.append((a, least))
    return low[at], free[at]


def both_lows(x: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    return [lows(x, at), lows(x[::-1], len(x) - 1 - at)]


def find_peaks(profile: np.ndarray, height: float = HEIGHT, distance: int = DISTANCE, prominence: float = PROMINENCE) -> list[int]:
    """The peaks of one array."""
    x = np.asarray(profile, dtype=float)
    at = maxima(x)
    at = at[x[at] >= height]
    at = at[apart(at, x[at], distance) == 1]
    (left, _), (right, _) = both_lows(x, at)
    return at[x[at] - np.maximum(left, right) >= prominence].tolist()


def peaks(profiles: DataFrame, key: str = "seq_id", **limits) -> DataFrame:
    """`key` and peak (a position) of each row's profile, an array of doubles."""

    def run(batches):
        for b in batches:
            rows = [(k, p) for k, v in zip(b[key], b["profile"], strict=True) for p in find_peaks(v, **limits)]
            yield pd.DataFrame(rows, columns=[key, "peak"])

    return profiles.select(F.col(key).cast("long"), "profile").mapInPandas(run, f"`{key}` long, peak int")


def _whole(keys: tuple[pa.Scalar, ...], n: int) -> pa.Array:
    return pa.repeat(keys[0], n)


def _ordered(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    pos, x = t["_pos"].to_numpy(), t["_x"].to_numpy()
    order = np.argsort(pos, kind="stable")
    return pos[order], x[order]


_EDGES = ("begin", "first_end", "last_start", "end"), ("first", "after", "before", "last", "low", "high")


def _candidates(rows: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """_key, _pos and _x of all local maxima, and of each tile what others must know of it."""
    places, values = _EDGES
    schema = f"_key {kind}, _tile long, _pos long, _x double, " + ", ".join([*(f"{c} long" for c in places), *(f"{c} double" for c in values)])

    def own(keys: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        pos, x = _ordered(t)
        if pos[-1] - pos[0] + 1 != len(pos) or np.isnan(x).any():
            raise ValueError("positions aren't consecutive, or a value is missing")
        first, last = plateaus(x)
        v = x[first]
        top = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1 if len(v) > 2 else np.empty(0, int)
        n = len(top)
        one = len(v) == 1
        facts = [pos[0], pos[last[0]], pos[first[-1]], pos[-1], v[0], None if one else v[1], None if one else v[-2], v[-1], x.min(), x.max()]
        columns = {
            "_key": _whole(keys, n + 1), "_tile": _whole(keys[1:], n + 1),
            "_pos": pa.array([*((pos[first[top]] + pos[last[top]]) // 2).tolist(), None], pa.int64()), "_x": pa.array([*v[top].tolist(), None], pa.float64()),
        }
        for name, fact in zip((*places, *values), facts, strict=True):
            columns[name] = pa.array([None] * n + [None if fact is None else fact.item()], pa.int64() if name in places else pa.float64())
        return pa.table(columns)

    found = checkpointed(rows.groupBy("_key", "_tile").applyInArrow(own, schema))
    tiles = found.filter("begin IS NOT NULL").select("_key", "_tile", *places, *values)

    def across(keys: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        """The maxima on plateaus that reach the edge of a tile, whatever number of tiles they go through."""
        made: list[tuple[int, float]] = []
        run = None  # the plateau that may go on: start, end, value, the value before it

        def close(after: float | None) -> None:
            start, end, value, before = run
            if before is not None and after is not None and before < value > after:
                made.append(((start + end) // 2, value))

        for r in t.sort_by("_tile").to_pylist():
            if run and run[1] + 1 != r["begin"]:
                raise ValueError("positions aren't consecutive, or a value is missing")
            if run and run[2] == r["first"]:
                run = (run[0], r["first_end"], run[2], run[3])
            else:
                if run:
                    close(r["first"])
                run = (r["begin"], r["first_end"], r["first"], run[2] if run else None)
            if r["after"] is not None:
                close(r["after"])
                run = (r["last_start"], r["end"], r["last"], r["before"])
        return pa.table({"_key": _whole(keys, len(made)), "_pos": pa.array([p for p, _ in made], pa.int64()), "_x": pa.array([v for _, v in made], pa.float64())})

    edges = tiles.groupBy("_key").applyInArrow(across, f"_key {kind}, _pos long, _x double")
    return found.filter("_pos IS NOT NULL").select("_key", "_pos", "_x").unionAll(edges), tiles


def _apart(found: DataFrame, kind: str, distance: int, tile: int, halo: int) -> DataFrame:
    """The peaks that stay. A tile is told from its peaks and those of a halo; where that doesn't do, from a larger one."""

    def teller(halo: int):
        def tell(keys: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
            t, at = t.sort_by("_pos"), keys[1].as_py()
            pos, x, home = (t[c].to_numpy() for c in ("_pos", "_x", "_home"))
            state = apart(pos, x, distance, at * tile - halo, (at + 1) * tile + halo)
            own = (home == at) & (state != 0)
            return pa.table({"_key": _whole(keys, own.sum()), "_tile": _whole(keys[1:], own.sum()), "_pos": pos[own], "_x": x[own], "_told": state[own] == 1})

        return tell

    spaced, again = [], None
    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_tile") == F.col("_t"))
    while True:
        reached = F.sequence(F.floor((F.col("_pos") - halo) / tile), F.floor((F.col("_pos") + halo) / tile))
        near = found.withColumn("_home", F.floor(F.col("_pos") / tile)).withColumn("_tile", F.explode(reached))
        if again is not None:
            near = near.join(small(again), same, "left_semi")
        told = checkpointed(near.groupBy("_key", "_tile").applyInArrow(teller(halo), f"_key {kind}, _tile long, _pos long, _x double, _told boolean"))
        again = checkpointed(told.filter("NOT _told").select(F.col("_key").alias("_k"), F.col("_tile").alias("_t")).distinct())
        spaced.append(told.join(small(again), same, "left_anti").drop("_told"))
        if again.isEmpty():
            return reduce(DataFrame.unionAll, spaced)
        halo *= 8


def tiled_peaks(rows: DataFrame, key: str = "seq_id", pos: str = "pos", value: str = "value", height: float = HEIGHT, distance: int = DISTANCE, prominence: float = PROMINENCE, tile: int = TILE, halo: int | None = None) -> DataFrame:
    """`key` and peak of profiles given as a row for each position, of any length: no task has more than a tile, or its peaks.

    Positions of a key are consecutive and its values are numbers; else it is an error. Plateaus go on over tiles; peaks that are
    too near are told with a halo, grown only where a chain of ever higher peaks leaves it; walls beyond a tile are found by
    the greatest values of tiles, and then in the one tile that has them. The result is that of find_peaks on the whole.
    """
    kind = rows.schema[key].dataType.simpleString()
    flat = rows.select(F.col(key).alias("_key"), F.floor(F.col(pos) / tile).alias("_tile"), F.col(pos).cast("long").alias("_pos"), F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))).alias("_x"))
    found, tiles = _candidates(flat, kind)
    kept = checkpointed(_apart(found.filter(F.col("_x") >= height), kind, distance, tile, halo or 64 * distance))
    # _low of each side (0: left, 1: right); where it goes on beyond the tile, _to is this one, and then the tile in which it ends
    schema = f"_key {kind}, _pos long, _x double, _side int, _low double, _to long"

    def within(keys: tuple[pa.Scalar, ...], t: pa.Table, ours: pa.Table) -> pa.Table:
        if not ours.num_rows:
            return pa.schema([("_key", keys[0].type), ("_pos", pa.int64()), ("_x", pa.float64()), ("_side", pa.int32()), ("_low", pa.float64()), ("_to", pa.int64())]).empty_table()
        place, x = _ordered(t)
        at, top = ours["_pos"].to_numpy(), ours["_x"].to_numpy()
        sides, lowest, to = np.repeat(np.array([0, 1], np.int32), len(at)), [], []
        for low, free in both_lows(x, at - place[0]):
            lowest.append(low)
            to += [keys[1].as_py() if f else None for f in free.tolist()]
        return pa.table({"_key": _whole(keys, len(sides)), "_pos": np.tile(at, 2), "_x": np.tile(top, 2), "_side": sides, "_low": np.concatenate(lowest), "_to": pa.array(to, pa.int64())})

    def beyond(keys: tuple[pa.Scalar, ...], t: pa.Table, free: pa.Table) -> pa.Table:
        """What is known of the other tiles of a profile: the first that has what is higher, and the least up to it."""
        if t.num_rows > MOST_TILES:
            raise ValueError(f"more than {MOST_TILES} tiles")
        t = t.sort_by("_tile")
        numbers, least, most = (t[c].to_numpy() for c in ("_tile", "low", "high"))
        top, side, low = (free[c].to_numpy() for c in ("_x", "_side", "_low"))
        low, here, to = low.copy(), np.searchsorted(numbers, free["_to"].to_numpy()), []
        for i, (k, s) in enumerate(zip(here.tolist(), side.tolist(), strict=True)):
            number, below, above = (c[k + 1 :] if s else c[:k][::-1] for c in (numbers, least, most))  # nearest first
            first, step = None, 64
            for at in range(0, len(above), step):
                if (above[at : at + step] > top[i]).any():
                    first = at + int((above[at : at + step] > top[i]).argmax())
                    break
            low[i] = min(low[i], below[:first].min(initial=np.inf))
            to.append(None if first is None else number[first].item())
        return pa.table({"_key": free["_key"], "_pos": free["_pos"], "_x": top, "_side": side, "_low": low, "_to": pa.array(to, pa.int64())})

    told = checkpointed(flat.groupBy("_key", "_tile").cogroup(kept.groupBy("_key", "_tile")).applyInArrow(within, schema))
    free = told.filter("_to IS NOT NULL")
    sides = checkpointed(told.filter("_to IS NULL").unionAll(tiles.groupBy("_key").cogroup(free.groupBy("_key")).applyInArrow(beyond, schema)))
    open_ = sides.filter("_to IS NOT NULL").withColumnRenamed("_to", "_tile")

    def ended(keys: tuple[pa.Scalar, ...], t: pa.Table, asked: pa.Table) -> pa.Table:
        _, x = _ordered(t)
        top, side, low = (asked[c].to_numpy() for c in ("_x", "_side", "_low"))
        out = low.copy()
        for s, v in ((0, x[::-1]), (1, x)):  # from the edge that the peak is beyond
            most, least = np.maximum.accumulate(v), np.concatenate(([np.inf], np.minimum.accumulate(v)))
            mine = side == s
            out[mine] = np.minimum(low[mine], least[np.searchsorted(most, top[mine], "right")])
        return pa.table({"_key": asked["_key"], "_pos": asked["_pos"], "_x": top, "_side": side, "_low": out, "_to": pa.nulls(len(top), pa.int64())})

    asked = open_.select(F.col("_key").alias("_k"), F.col("_tile").alias("_t")).distinct()
    there = flat.join(asked, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_tile") == F.col("_t")), "left_semi")
    rest = there.groupBy("_key", "_tile").cogroup(open_.groupBy("_key", "_tile")).applyInArrow(ended, schema)
    stands = sides.filter("_to IS NULL").unionAll(rest).groupBy("_key", "_pos", "_x").agg(F.max("_low").alias("_low"))
    return stands.filter(F.col("_x") - F.col("_low") >= prominence).select(F.col("_key").alias(key), F.col("_pos").alias("peak"))
