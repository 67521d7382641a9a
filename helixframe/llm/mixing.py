"""Mixing sources to target weights: Pfair windows for each source's blocks, earliest deadline first.

The rows are handled with DataFrame and SQL functions only. What is worked out beforehand is the plan: a schedule for
each phase (until a source runs out), which depends on the weights and the number of blocks of each source, not on the
rows. Weights are whole numbers, so that after one cycle of as many slots as they sum to every source has had exactly its
share, and the same cycle can follow without end.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, buckets_for, numbered

#: Rows of a block, and what default weights sum to.
BLOCK, PARTS = 16, 1 << 16
#: The most slots of a cycle, and of a whole plan; more is an error.
MOST_CYCLE, MOST_PLAN = 1 << 18, 1 << 22
#: Slots in a row of the plan, and about the bytes of a row without them.
CHUNK, ROW_BYTES = 1000, 100


def whole_weights(weights: dict[str, float], total: int) -> dict[str, int]:
    """Weights as whole numbers, 1 or more each, that sum to max(total, sources): largest remainders."""
    total, whole = max(total, len(weights)), sum(weights.values())
    exact = {s: w / whole * total for s, w in weights.items()}
    parts = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s)):
        if sum(parts.values()) < total:
            parts[s] += 1
    while sum(parts.values()) > total:  # where tiny weights were raised to 1
        s = max(parts, key=lambda s: (parts[s] - exact[s] if parts[s] > 1 else -total, s))
        parts[s] -= 1
    return parts


def exact_weights(weights: dict[str, float | Fraction]) -> dict[str, int]:
    """The least whole numbers in the ratio of the weights, floats as they are written (0.1 is a tenth)."""
    exact = {s: Fraction(repr(float(w)) if isinstance(w, float) else w) for s, w in weights.items()}
    if min(exact.values()) <= 0:
        raise ValueError("weights must be over 0")
    down = lcm(*(x.denominator for x in exact.values()))
    up = {s: int(x * down) for s, x in exact.items()}
    common = gcd(*up.values())
    parts = {s: x // common for s, x in up.items()}
    if sum(parts.values()) > MOST_CYCLE:
        raise ValueError(f"weights must be in the ratio of whole numbers that sum to at most {MOST_CYCLE}, not {sum(parts.values())}")
    return parts


def pfair_slots(weights: dict[str, int], left: dict[str, int] | None = None) -> list[str]:
    """The source of each slot, from a slot where every source has had its share, for a cycle or until one has run its left[s] blocks.

    With n the sum of the weights, block j (from 0) of s is released at floor(j * n / weights[s]) and due by
    ceil((j + 1) * n / weights[s]); of the released blocks the one with the earliest deadline runs (ties by source).
    Utilisation is 1, so every block runs within its window, and after any t slots a source has had less than one block
    more or less than t * weights[s] / n. After n slots every source has had weights[s] blocks.
    """
    n = sum(weights.values())
    waiting = [(0, s, 0) for s in sorted(weights)]  # release, source, block
    ready: list[tuple[int, str, int]] = []
    slots: list[str] = []
    while len(slots) < n:
        while waiting and waiting[0][0] <= len(slots):
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * n // weights[s]), s, j))
        due, s, j = heapq.heappop(ready)
        assert len(slots) < due
        slots.append(s)
        if left and j + 1 == left[s]:
            break
        heapq.heappush(waiting, ((j + 1) * n // weights[s], s, j + 1))
    return slots


def _phases(blocks: dict[str, int], weights: dict[str, int]) -> Iterator[tuple[list[str], int]]:
    """(source of each slot, how many times in a row) in turn, until every block is placed.

    Rates change only at the slot where a source runs out: from there the others go on with the weights they have among
    themselves. Until then whole cycles are repeated, as long as every source has more than enough for one; up to one more follows.
    """
    left, planned = {s: n for s, n in blocks.items() if n}, 0
    while left:
        common = gcd(*(weights[s] for s in left))
        share = {s: weights[s] // common for s in left}
        times = min((left[s] - 1) // share[s] for s in left)
        slots = pfair_slots(share, None if times else left)
        planned += len(slots)
        if planned > MOST_PLAN:
            raise ValueError(f"a plan for {len(blocks)} sources has over {MOST_PLAN} slots: take larger blocks or weights that sum to less")
        yield slots, times or 1
        ran = Counter(slots)
        left = {s: n for s, m in left.items() if (n := m - (times or 1) * ran[s])}


def plan_phases(blocks: dict[str, int], weights: dict[str, int]) -> list[tuple[dict[str, int], int]]:
    """(blocks of each source in a run of slots, how many times it is repeated) in turn, until every block is placed."""
    return [(dict(Counter(slots)), times) for slots, times in _phases(blocks, weights)]


def _plan_rows(blocks: dict[str, int], weights: dict[str, int]) -> tuple[list[tuple], list[tuple]]:
    """For each source and phase: source, phase, its blocks [start, stop), blocks a cycle, first slot, slots a cycle.
    And for each CHUNK of its blocks in a cycle: source, phase, chunk, their slots in the cycle."""
    done, first, rows, chunks = dict.fromkeys(blocks, 0), 0, [], []
    for phase, (slots, times) in enumerate(_phases(blocks, weights)):
        own: dict[str, list[int]] = {}
        for at, s in enumerate(slots):
            own.setdefault(s, []).append(at)
        for s, mine in own.items():
            rows.append((s, phase, done[s], done[s] + times * len(mine), len(mine), first, len(slots)))
            chunks += [(s, phase, k, mine[k * CHUNK : (k + 1) * CHUNK]) for k in range(-(-len(mine) // CHUNK))]
            done[s] += times * len(mine)
        first += len(slots) * times
    return rows, chunks


def target_weights(counts: dict[str, int], weights: dict[str, float | Fraction] | None, power: float) -> dict[str, int]:
    """The whole-number weight of each source: those given, exactly; with sources that none is given for, all are rounded together."""
    if weights and min(weights.values()) <= 0:
        raise ValueError("weights must be over 0")
    if not counts or (weights and weights.keys() >= counts.keys()):
        return exact_weights({s: weights[s] for s in counts}) if counts else {}
    parts = max(len(counts), min(PARTS, MOST_PLAN // (2 * len(counts))))
    return whole_weights({s: float((weights or {}).get(s, n**power)) for s, n in counts.items()}, parts)


def mix_sources(docs: DataFrame, weights: dict[str | None, float | Fraction] | None = None, power: float = 0.5, block: int = BLOCK, key: str = "doc_id", source: str = "source") -> DataFrame:
    """`key`, `source`, block (of its source), slot (of the block among all blocks) and position of every row.

    weights: of sources, taken exactly; they must be in the ratio of whole numbers that sum to at most MOST_CYCLE. Where
    None or not all sources are named, the others weigh their number of rows to the `power`, and the target weights are
    all these in whole parts of PARTS (fewer from 32 sources on, so that the plan stays bounded). Until the first source
    runs out, and between any two that do, a source has less than a block more or less than its target weight's share,
    however long the table. Every row has one position; none is dropped or repeated, so once a source has no rows left,
    the others share its place. Positions are distinct and ascend in the mixed order; a source's last block may be
    short, which leaves a gap. Rows of a source are taken by bucket of the key's hash, then by key. A null source is a
    source like any other, named by None; null keys and repeated rows are rows like any other; an empty table gives no
    rows; texts aren't read. A weight that isn't over 0 is an error. One row per source reaches the driver; the plan has
    at most a cycle's slots in each of at most two phases per source, and over MOST_PLAN slots in all are an error.
    """
    return _placed(docs.select(key, source), weights, power, block, key, source, [key]).select(key, source, "block", "slot", "position")


def _placed(docs: DataFrame, weights: dict[str | None, float] | None, power: float, block: int, key: str, source: str, order: list[str]) -> DataFrame:
    """`docs` with block, slot and position (see `mix_sources`); rows of a source are taken by bucket of `order`'s hash, then by `order`."""
    name = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))  # tells null from "null"
    rows = docs.select("*", name.alias("_name"))
    counts = {r["_name"]: r["n"] for r in rows.groupBy("_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    named = {"null" if s is None else f"={s}": w for s, w in (weights or {}).items()}
    made, chunks = _plan_rows({s: -(-n // block) for s, n in counts.items()}, target_weights(counts, named, power))
    plan = docs.sparkSession.createDataFrame(made, "_s string, _phase long, _start long, _stop long, _k long, _first long, _n long")
    slots = docs.sparkSession.createDataFrame(chunks, "_s2 string, _phase2 long, _chunk long, _slots array<int>")
    put = numbered(rows, "_name", order, "_seq", buckets_for(max(counts.values(), default=0))).withColumn("block", F.floor(F.col("_seq") / block))
    hit = put.join(F.broadcast(plan) if ROW_BYTES * len(made) <= BROADCAST_BYTES else plan, (F.col("_name") == F.col("_s")) & (F.col("block") >= F.col("_start")) & (F.col("block") < F.col("_stop")))
    since = F.col("block") - F.col("_start")
    at = since % F.col("_k")
    here = (F.col("_name") == F.col("_s2")) & (F.col("_phase") == F.col("_phase2")) & (F.floor(at / CHUNK) == F.col("_chunk"))
    hit = hit.join(F.broadcast(slots) if ROW_BYTES * len(chunks) + 4 * sum(r[4] for r in made) <= BROADCAST_BYTES else slots, here)
    slot = F.col("_first") + F.floor(since / F.col("_k")) * F.col("_n") + F.get("_slots", (at % CHUNK).cast("int"))
    return hit.withColumn("slot", slot).withColumn("position", F.col("slot") * block + F.col("_seq") % block)


def in_mixed_order(docs: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.5, block: int = BLOCK, key: str = "doc_id", source: str = "source") -> DataFrame:
    """`docs` with its rows laid out in mixed order: partitions are ranges of positions, sorted within.

    Rows are carried along, not joined back by key, so keys may be null or repeated; rows of a source are taken by bucket
    of the hash of the key and the whole row, then by those. Weights and limits are those of `mix_sources`; nulls in any
    column, empty and very long texts and columns of any name are carried as they are; an empty table gives none.
    """
    whole = docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), F.xxhash64(*docs.columns).alias("_tie"), F.struct(*docs.columns).alias("_doc"))
    at = _placed(whole, weights, power, block, "_key", "_source", ["_key", "_tie"]).select("position", "_doc")
    return at.repartitionByRange("position").sortWithinPartitions("position").select("_doc.*")
