"""The banded aligner against a plain dynamic program, and its patches against the chains they go into."""

import random
import time

import pytest

from helixframe.operators import alignment as al

LETTERS = "ACGT"


def pair_score(a, b):
    a, b = a.upper(), b.upper()
    return al.HOXD70[LETTERS.index(a)][LETTERS.index(b)] if a in LETTERS and b in LETTERS else al.OTHER_SCORE


def plain_score(t, q):
    """The best local score with affine gaps, cell by cell."""
    low, best = -(10**9), 0
    h, f = [0] * (len(q) + 1), [low] * (len(q) + 1)
    for a in t:
        new, e = [0], low
        for j, b in enumerate(q, 1):
            e = max(e, new[j - 1] - al.GAP_OPEN) - al.GAP_LETTER
            f[j] = max(f[j], h[j] - al.GAP_OPEN) - al.GAP_LETTER
            new.append(max(0, h[j - 1] + pair_score(a, b), e, f[j]))
        h = new
        best = max(best, *h)
    return best


def rescored(t, q, found):
    """What an alignment's own blocks score, and where they end."""
    i, j, total = found.t_start, found.q_start, 0
    for size, dt, dq in found.blocks:
        assert size > 0
        total += sum(pair_score(t[i + x], q[j + x]) for x in range(size))
        i, j = i + size + (dt or 0), j + size + (dq or 0)
        total -= sum(al.GAP_OPEN + al.GAP_LETTER * n for n in (dt, dq) if n)
    assert (i, j) == (found.t_end, found.q_end) and found.blocks[-1][1:] == (None, None)
    return total


def planted(rng, t, edits):
    q = list(t)
    for _ in range(edits):
        at, kind = rng.randrange(len(q) + 1), rng.random()
        if kind < 0.5 and at < len(q):
            q[at] = rng.choice(LETTERS + "N")
        elif kind < 0.75:
            q[at:at] = rng.choices(LETTERS, k=rng.randrange(1, 12))
        else:
            del q[at : at + rng.randrange(1, 12)]
    return "".join(q)


@pytest.fixture(scope="module")
def letters(spark):
    from helixframe.plans import views

    return "".join(r.seq for r in views.sequences(spark, "/root/testdata/sf0.001").orderBy("chrom").collect())


def test_2000_small_gaps_as_a_plain_program(letters):
    rng = random.Random(11)
    ts, qs = [], []
    for k in range(2000):
        at = rng.randrange(len(letters) - 60)
        t = letters[at : at + rng.randrange(1, 60)]
        ts.append(t)
        qs.append(planted(rng, t, rng.randrange(6)) if k % 10 else letters[at + 7 : at + 40] if k % 20 else "".join(rng.choices(LETTERS, k=25)))
    found = al.best_alignments(ts, qs)
    for t, q, a in zip(ts, qs, found, strict=True):
        want = plain_score(t, q)
        assert (a.score if a else 0) == want
        assert a is None or rescored(t, q, a) == want


def test_small_gaps_cost_little_of_what_a_plain_program_does():
    rng = random.Random(13)
    ts = ["".join(rng.choices(LETTERS, k=rng.randrange(10, 120))) for _ in range(6000)]
    qs = [planted(rng, t, 5) for t in ts]
    began = time.perf_counter()
    for t, q in zip(ts[:40], qs[:40], strict=True):
        plain_score(t, q)
    plain = (time.perf_counter() - began) / 40
    began = time.perf_counter()
    al.best_alignments(ts, qs)
    assert (time.perf_counter() - began) / 6000 < plain / 20


def test_long_gaps_in_a_band():
    rng = random.Random(12)
    t = "".join(rng.choices(LETTERS, k=6000))
    q = "".join(rng.choices(LETTERS, k=2000)) + planted(rng, t[1000:5000], 60) + "".join(rng.choices(LETTERS, k=500))
    began = time.time()
    whole, banded, narrow = (al.best_alignments([t], [q], band=b)[0] for b in (1 << 20, 1024, 600))
    assert whole.score == banded.score == narrow.score == rescored(t, q, banded) and whole.score > 300_000
    assert 900 < banded.t_start < 1100 and 1900 < banded.q_start < 2100
    # time grows with the length and not with its square
    t, q = t * 8, q * 8
    began = time.time()
    far = al.best_alignments([t], [q], band=512)[0]
    assert rescored(t, q, far) == far.score >= banded.score * 0.9 and time.time() - began < 30


def test_groups_of_like_size_change_nothing(letters, monkeypatch):
    rng = random.Random(13)
    ts = [letters[a : a + rng.randrange(1, 200)] for a in range(0, 6000, 150)]
    qs = [planted(rng, t, 4) for t in ts]
    want = [a and a.score for a in al.best_alignments(ts, qs)]
    monkeypatch.setattr(al, "TRACE_BYTES", 1)
    assert [a and a.score for a in al.best_alignments(ts, qs)] == want
    assert al.best_alignments([None, "", "ACGT", "NNNN"], ["A", "A", None, "NNNN"]) == [None] * 4
    small = al.best_alignments(["acgtacgtac"], ["ACGTACGTAC"])[0]
    assert small == al.Alignment(al.best_alignments(["ACGTACGTAC"], ["ACGTACGTAC"])[0].score, 0, 10, 0, 10, [(10, None, None)])


def test_a_seeded_band_is_found():
    rng = random.Random(14)
    t, q = ("".join(rng.choices(LETTERS, k=3000)) for _ in range(2))
    q = q[:2500] + t[200:700] + q[2500:]
    code = al._LETTERS
    import numpy as np

    at = al.seeded_diagonal(code[np.frombuffer(t.encode(), np.uint8)], code[np.frombuffer(q.encode(), np.uint8)], 200)
    assert at <= 2300 < at + 200 and abs(at + 100 - 2300) <= 2


def test_registered_query(spark):
    """Every 16th gap of the query against a plain program, and what all do to their chains."""
    from helixframe.operators import chains
    from helixframe.plans import catalogue, views

    sf = "/root/testdata/sf0.01"  # the smaller set has no gap of over ten letters on the query
    placed = chains.coordinates(views.blocks(spark, sf)).cache()
    jobs = {(r.chain_id, r.block_no): r for r in catalogue.edited_gaps(spark, sf, placed).collect()}
    assert len(jobs) > 30_000 and all(len(r.t_seq) == r.dt and len(r.q_seq) == r.dq for r in jobs.values())
    found = {(r.chain_id, r.block_no): r for r in al.aligned_gaps(catalogue.edited_gaps(spark, sf, placed)).collect()}
    for key in sorted(jobs)[::16]:
        want = plain_score(jobs[key].t_seq, jobs[key].q_seq)
        assert (found[key].score if key in found else 0) == want
    parts = {}
    for r in catalogue.gap_realignment(spark, sf).collect():
        parts.setdefault((r.chain_id, r.block_no), []).append((r.part, r["size"], r.dt, r.dq))
    patched = 0
    for b in placed.collect():
        mine = [x[1:] for x in sorted(parts[b.chain_id, b.block_no])]
        key = b.chain_id, b.block_no
        if key in found and found[key].score >= 2000:
            patched += 1
            a, job = found[key], jobs[key]
            want = [(b["size"], a.t_start - job.t0, a.q_start - job.q0), *[tuple(x) for x in a.blocks[:-1]], (a.blocks[-1]["size"], job.t0 + b.dt - a.t_end, job.q0 + b.dq - a.q_end)]
            assert mine == want and sum(s + t for s, t, _ in mine) == b["size"] + b.dt and sum(s + q for s, _, q in mine) == b["size"] + b.dq
        else:
            assert mine == [(b["size"], b.dt, b.dq)]
    assert patched > 1000
