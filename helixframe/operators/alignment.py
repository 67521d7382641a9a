"""Local alignment with affine gap costs, by anti-diagonals in a band, of many pairs of sequences at once."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The scores of the HOXD70 matrix (A, C, G, T by A, C, G, T), and what a gap's opening and each of its letters cost.
HOXD70 = ((91, -114, -31, -123), (-114, 100, -125, -31), (-31, -125, 100, -114), (-123, -31, -114, 91))
GAP_OPEN, GAP_LETTER = 400, 30
#: Any other letter against any letter.
OTHER_SCORE = -100
#: Pairs with at most so many diagonals are aligned over all of them; others in a band of so many around the best seeded one.
BAND = 1_024
#: Letters of a seed; seeds that are in the query more often than this don't vote for a diagonal.
SEED, SEED_MOST = 12, 16
#: Cells that are kept for tracing back at once (bytes), over all pairs of a group; one pair alone may take more.
TRACE_BYTES = 64 << 20
#: Pairs of a group, so that an anti-diagonal of all of them stays in a core's cache.
GROUP = 1024

_MOST_16 = 16_000  # scores up to this, either way, are worked out in 16 bits
_LETTERS = np.full(256, 4, np.uint8)
for _k, _pair in enumerate(("Aa", "Cc", "Gg", "Tt")):
    for _x in _pair:
        _LETTERS[ord(_x)] = _k


class Alignment(NamedTuple):
    """A pair's best local alignment: positions from 0 within the two, and (size, dt, dq) of its blocks, the last with None."""

    score: int
    t_start: int
    t_end: int
    q_start: int
    q_end: int
    blocks: list[tuple[int, int | None, int | None]]


class _Columns(NamedTuple):
    """Alignments by column: the place of each pair, what Alignment has of it, how many blocks; then blocks of all of them, one after the other."""

    place: np.ndarray
    score: np.ndarray
    t_start: np.ndarray
    t_end: np.ndarray
    q_start: np.ndarray
    q_end: np.ndarray
    n: np.ndarray
    size: np.ndarray
    dt: np.ndarray
    dq: np.ndarray


def _table(matrix, other: int, out: int, kind: type) -> np.ndarray:
    """Scores by (target code * 8 + query code); code 4 is another letter, 5 is beside the sequence."""
    table = np.full((8, 8), out, kind)
    table[:5, :5] = other
    table[:4, :4] = matrix
    return table.reshape(-1)


def seeded_diagonal(t: np.ndarray, q: np.ndarray, width: int) -> int:
    """The first diagonal (query minus target position) of a band of `width` that has most seeds in common, or of one around the middle."""
    lo, hi = -len(t), len(q)
    middle = (hi + lo - width) // 2
    if min(len(t), len(q)) < SEED:
        return middle
    power = 4 ** np.arange(SEED, dtype=np.int64)

    def seeds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        views = np.lib.stride_tricks.sliding_window_view(x, SEED)
        return views.astype(np.int64) @ power, np.convolve(x > 3, np.ones(SEED, int), "valid") == 0

    tk, t_ok = seeds(t)
    qk, q_ok = seeds(q)
    at_q = np.flatnonzero(q_ok)
    at_q = at_q[np.argsort(qk[at_q], kind="stable")]
    keys = qk[at_q]
    at_t = np.flatnonzero(t_ok)
    first, last = np.searchsorted(keys, tk[at_t]), np.searchsorted(keys, tk[at_t], "right")
    n = np.where(last - first <= SEED_MOST, last - first, 0)
    if not n.sum():
        return middle
    which = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    votes = np.bincount(at_q[which] - np.repeat(at_t, n) - lo, minlength=hi - lo + 1)
    total = np.concatenate(([0], np.cumsum(votes)))
    ends = np.minimum(np.arange(len(votes)) + width, len(votes))
    best = total[ends] - total[: len(votes)]
    first_best = int(best.argmax())
    tied = first_best + int(np.argmax(best[first_best:] < best[first_best])) - 1  # the band's votes in its middle
    return lo + (first_best + max(tied, first_best)) // 2


def _letters(codes: np.ndarray, first: np.ndarray, begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """(n, pairs): codes from `first` on, 5 where that isn't in [begin, end)."""
    at = first + np.arange(n)[:, None]
    return np.where((at >= begin) & (at < end), codes.take(at, mode="clip"), np.uint8(5))


def _align(t: np.ndarray, q: np.ndarray, width: int | None, scoring: tuple) -> tuple[np.ndarray, ...]:
    """Best alignments of pairs, a column of codes each, within the diagonals 0 to `width` (None: all), as (pair, score, i, j, operations).

    Cells are worked out by anti-diagonals (d = i + j, from 1 each), those of all pairs together: a diagonal is (i, pair), so that
    what a cell needs is the same place, or the one before, of one or two diagonals before. Only cells within the pairs and the
    band are. Of equally good ends the first diagonal's with the greatest i counts.
    """
    matrix, gap_open, gap_letter, other = scoring
    (rows, n), columns = t.shape, len(q)
    most = max(1, int(np.max(matrix)), other) * min(rows, columns)
    narrow = max(most, abs(int(np.min(matrix))), abs(other), 2 * gap_letter + gap_open) <= _MOST_16
    kind, low = (np.int16, -_MOST_16) if narrow else (np.int32, -(1 << 30))
    table = _table(matrix, other, low, kind)
    ds = np.arange(rows + columns + 1)
    lo, hi = np.maximum(1, ds - columns), np.minimum(rows, ds - 1)
    if width is not None:
        lo, hi = np.maximum(lo, (ds - width + 2) // 2), np.minimum(hi, ds // 2)
    cells = np.maximum(hi - lo + 1, 0)
    cells[:2] = 0
    first = np.cumsum(cells) - cells
    trace = np.empty((int(cells.sum()), n), np.uint8)
    ts, qs = t << 3, q[::-1]
    step = kind(gap_open + gap_letter)
    made = lambda value, k: [np.full((rows + 2, n), value, kind) for _ in range(k)]
    hs, gs, es, fs = made(0, 3), made(-step, 2), made(low, 2), made(low, 2)  # gs: h less a gap of one; es and fs: less a letter
    room = [np.empty((min(rows, columns) + 1, n), x) for x in (np.uint8, kind, kind, kind, np.uint8)]
    best, best_d, best_i = np.zeros(n, kind), np.zeros(n, np.int64), np.zeros(n, np.int64)
    places = np.arange(rows + 2, dtype=np.min_scalar_type(rows + 2))[:, None]
    letter, zero = kind(gap_letter), kind(0)
    for d in range(2, rows + columns + 1):
        a, z = int(lo[d]), int(hi[d]) + 1
        if a >= z:
            break
        h2, g1, e1, f1 = hs[d % 3], gs[d % 2], es[d % 2], fs[d % 2]
        g0, e0, f0 = gs[1 - d % 2], es[1 - d % 2], fs[1 - d % 2]
        h0 = hs[(d + 2) % 3]
        code, h, e, f, bit = (x[: z - a] for x in room)
        way = trace[first[d] : first[d] + z - a]
        np.bitwise_or(ts[a - 1 : z - 1], qs[columns - d + a : columns - d + z], out=code)
        np.take(table, code, out=h, mode="clip")
        np.add(h, h2[a - 1 : z - 1], out=h)
        np.maximum(h, zero, out=h)
        np.greater(h, zero, out=way.view(bool))

        def marked(x: np.ndarray, y: np.ndarray, mark: int, bit: np.ndarray = bit, way: np.ndarray = way) -> None:
            np.greater(x, y, out=bit.view(bool))
            np.multiply(bit, np.uint8(mark), out=bit)
            np.bitwise_or(way, bit, out=way)

        e_left, g_left, f_up, g_up = e1[a:z], g1[a:z], f1[a - 1 : z - 1], g1[a - 1 : z - 1]
        marked(e_left, g_left, 8)
        marked(f_up, g_up, 16)
        np.maximum(e_left, g_left, out=e)
        np.maximum(f_up, g_up, out=f)
        marked(e, h, 2)
        np.maximum(h, e, out=h)
        marked(f, h, 4)
        own = h0[a:z]
        np.maximum(h, f, out=own)
        np.subtract(own, step, out=g0[a:z])
        np.subtract(e, letter, out=e0[a:z])
        np.subtract(f, letter, out=f0[a:z])
        for edge in (a - 1, z):
            h0[edge], g0[edge], e0[edge], f0[edge] = 0, -step, low, low
        top = own.max(0)
        if (more := top > best).any():
            np.equal(own, top, out=bit.view(bool))
            at = np.multiply(bit, places[a:z]).max(0)
            best_d[more], best_i[more] = d, at[more]
            np.maximum(best, top, out=best)
    found = np.flatnonzero(best > 0)
    traced = _traced if len(found) >= 8 else _traced_singly
    return found, best[found].astype(np.int64), best_i[found], best_d[found] - best_i[found], traced(trace, first - lo, found, best_d[found], best_i[found])


# by what a cell's byte says: how its value came about (0 nothing, 1 a pair, 2 a query letter, 3 a target letter), and how the way back goes on
_CELL = np.arange(32)
_WAY = np.where(_CELL & 4, 3, np.where(_CELL & 2, 2, _CELL & 1))
_OP = np.stack([np.zeros(32, int), _WAY, np.full(32, 2), np.full(32, 3)])
_STATE = np.stack([np.ones(32, int), np.ones(32, int), np.where(_CELL & 8, 2, 1), np.where(_CELL & 16, 3, 1)])
_DOWN_D, _DOWN_I = np.array([0, 2, 1, 1]), np.array([0, 1, 0, 1])


def _traced(trace: np.ndarray, base: np.ndarray, pairs: np.ndarray, d: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Operations (pair, step) of the ways back from the best cells, 0 behind each one's last; all pairs go a step at once."""
    n, flat = trace.shape[1], trace.reshape(-1)
    rows, state, made = np.arange(len(pairs)), np.ones(len(pairs), int), []
    while len(rows):
        inside = (i > 0) & (d > i)
        cell = flat[np.where(inside, (base[d] + i) * n + pairs, 0)]
        op = np.where(inside, _OP[state, cell], 0)
        on = op > 0
        if not on.all():
            rows, pairs, d, i, op, cell = rows[on], pairs[on], d[on], i[on], op[on], cell[on]
        made.append((rows, op))
        state, d, i = _STATE[op, cell], d - _DOWN_D[op], i - _DOWN_I[op]
    ops = np.zeros((len(made[0][0]) if made else 0, len(made)), np.uint8)
    for k, (own, op) in enumerate(made):
        ops[own, k] = op
    return ops


def _traced_singly(trace: np.ndarray, base: np.ndarray, pairs: np.ndarray, d: np.ndarray, i: np.ndarray) -> np.ndarray:
    """As _traced, a pair at a time: for a few long ones."""
    op_of, state_of, made = _OP.tolist(), _STATE.tolist(), []
    for b, x, y in zip(pairs.tolist(), d.tolist(), i.tolist(), strict=True):
        own, state = bytearray(), 1
        while y > 0 and x > y:
            cell = int(trace[base[x] + y, b])
            op = op_of[state][cell]
            if not op:
                break
            own.append(op)
            state = state_of[op][cell]
            x, y = x - (2 if op == 1 else 1), y - (op != 2)
        made.append(np.frombuffer(bytes(own), np.uint8))
    ops = np.zeros((len(made), max(map(len, made), default=0)), np.uint8)
    for k, own in enumerate(made):
        ops[k, : len(own)] = own
    return ops


def _blocks(ops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many blocks each row of operations (from its end) has, and their sizes and gaps behind them, in order."""
    flat = ops[:, ::-1].reshape(-1)
    kept = np.flatnonzero(flat)
    op, pair = flat[kept], kept // max(ops.shape[1], 1)
    paired = op == 1
    begins = paired & ~np.concatenate(([False], paired[:-1] & (pair[1:] == pair[:-1])))[: len(op)]
    block = np.cumsum(begins) - 1
    count = lambda kind: np.bincount(block[op == kind], minlength=int(begins.sum()))
    return np.bincount(pair[begins], minlength=len(ops)), count(1), count(3), count(2)


def _columns(targets: list[str | None], queries: list[str | None], band: int = BAND, matrix=HOXD70, gap_open: int = GAP_OPEN, gap_letter: int = GAP_LETTER, other: int = OTHER_SCORE) -> _Columns:
    """See best_alignments; pairs without an alignment aren't there, and others aren't in order."""
    band += band % 2
    (t, t_end), (q, q_end) = (
        (_LETTERS[np.frombuffer("".join(s or "" for s in own).encode("latin-1", "replace"), np.uint8)], np.cumsum([len(s or "") for s in own], dtype=np.int64)) for own in (targets, queries)
    )
    t_len, q_len = np.diff(t_end, prepend=0), np.diff(q_end, prepend=0)
    ready = np.flatnonzero((t_len > 0) & (q_len > 0))
    # a band of all diagonals is none; others begin at the diagonal `shift`, which is where the query is taken from
    banded, shift = t_len + q_len + 2 > band, np.zeros(len(t_len), np.int64)
    for b in ready[banded[ready]].tolist():
        shift[b] = seeded_diagonal(t[t_end[b] - t_len[b] : t_end[b]], q[q_end[b] - q_len[b] : q_end[b]], band)
    ready = ready[np.lexsort((ready, q_len[ready], t_len[ready] // 16, banded[ready]))]
    made, at = [], 0
    while at < len(ready):
        end, rows, columns = at, 0, 0
        while end < len(ready) and end - at < GROUP and banded[ready[end]] == banded[ready[at]]:
            more, wide = max(rows, int(t_len[ready[end]])), max(columns, int(q_len[ready[end]] - shift[ready[end]]))
            if end > at and (end + 1 - at) * (more * wide if not banded[ready[at]] else more * band) > TRACE_BYTES:
                break
            rows, columns, end = more, wide, end + 1
        own = ready[at:end]
        at = end
        width = band if banded[own[0]] else None
        columns = columns if width is None else min(columns, rows + width - 1)
        if columns < 1:
            continue
        t_from, q_from = t_end[own] - t_len[own], q_end[own] - q_len[own]
        ts = _letters(t, t_from, t_from, t_end[own], rows)
        pair, score, i, j, ops = _align(ts, _letters(q, q_from + shift[own], q_from, q_end[own], columns), width, (matrix, gap_open, gap_letter, other))
        place, j = own[pair], j + shift[own[pair]]
        made.append((place, score, i - np.isin(ops, (1, 3)).sum(1), i, j - np.isin(ops, (1, 2)).sum(1), j, *_blocks(ops)))
    return _Columns(*(np.concatenate(c) for c in zip(*made, strict=True))) if made else _Columns(*[np.empty(0, np.int64)] * 10)


def best_alignments(targets: list[str | None], queries: list[str | None], band: int = BAND, matrix=HOXD70, gap_open: int = GAP_OPEN, gap_letter: int = GAP_LETTER, other: int = OTHER_SCORE) -> list[Alignment | None]:
    """The best local alignment of each pair, None where no letters fit, one of the two is empty or null.

    A pair whose diagonals fit the band (an even number) is aligned exactly; a longer one within the band that has most seeds.
    Pairs are grouped by size, so that little is worked out beside them. Small letters count as capital ones.
    """
    out: list[Alignment | None] = [None] * len(targets)
    found = _columns(targets, queries, band, matrix, gap_open, gap_letter, other)
    sizes, dts, dqs, end = found.size.tolist(), found.dt.tolist(), found.dq.tolist(), 0
    for place, *facts, n in zip(*(c.tolist() for c in found[:7]), strict=True):
        begin, end = end, end + n
        out[place] = Alignment(*facts, [*zip(sizes[begin : end - 1], dts[begin : end - 1], dqs[begin : end - 1], strict=True), (sizes[end - 1], None, None)])
    return out


PATCHES = "chain_id long, block_no int, rank int, score long, t_start long, t_end long, q_start long, q_end long, blocks array<struct<size:long,dt:long,dq:long>>"


def aligned_gaps(jobs: DataFrame, t_seq: str = "t_seq", q_seq: str = "q_seq", **scoring) -> DataFrame:
    """Patches of gaps (chain_id, block_no, t0, q0 and two sequences): each gap's best alignment, rank 0; none where nothing fits."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(PATCHES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _columns(batch.column(4).to_pylist(), batch.column(5).to_pylist(), **scoring)
            chain, block, t0, q0 = (batch.column(k).take(pa.array(found.place)) for k in range(4))
            ends = np.cumsum(found.n)
            last = np.zeros(len(found.size), bool)
            last[ends - 1] = True
            parts = pa.StructArray.from_arrays([pa.array(found.size), pa.array(found.dt, mask=last), pa.array(found.dq, mask=last)], fields=list(schema.field("blocks").type.value_type))
            blocks = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), parts).cast(schema.field("blocks").type)
            t_start, t_end, q_start, q_end = (pc.add(x, pa.array(y)) for x, y in ((t0, found.t_start), (t0, found.t_end), (q0, found.q_start), (q0, found.q_end)))
            yield pa.RecordBatch.from_arrays([chain, block, pa.repeat(pa.scalar(0, pa.int32()), len(chain)), pa.array(found.score), t_start, t_end, q_start, q_end, blocks], schema=schema)

    return jobs.select(F.col("chain_id").cast("long"), F.col("block_no").cast("int"), F.col("t0").cast("long"), F.col("q0").cast("long"), t_seq, q_seq).mapInArrow(run, PATCHES)
