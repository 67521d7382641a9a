from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helixframe.llm import mixing as m


names = st.sampled_from("abcdefgh")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(names, st.integers(1, 40), min_size=1))
def test_cycle_never_deviates_by_a_block(weights):
    slots, n = m.pfair_slots(weights), sum(weights.values())
    seen = dict.fromkeys(weights, 0)
    for t, s in enumerate(slots, 1):
        seen[s] += 1
        assert all(abs(seen[x] * n - t * weights[x]) < n for x in weights)
    assert seen == weights


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(names, st.tuples(st.integers(1, 300), st.integers(1, 9)), min_size=1))
def test_phases_place_every_block_within_a_block_of_the_weights(sources):
    blocks, weights = ({s: x[k] for s, x in sources.items()} for k in (0, 1))
    seen, since, t, total = dict.fromkeys(blocks, 0), dict.fromkeys(blocks, 0), 0, sum(weights.values())
    for slots, times in m._phases(blocks, weights):
        for s in slots * times:
            since[s], t = since[s] + 1, t + 1
            assert all(abs(since[x] * total - t * weights[x]) < total for x in since)
            seen[s] += 1
            if seen[s] == blocks[s]:  # from here the others have their own total
                since, t = {x: 0 for x in since if seen[x] < blocks[x]}, 0
                total = sum(weights[x] for x in since)
    assert seen == blocks


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(names, st.floats(0.001, 1000), min_size=1), st.integers(1, 200))
def test_whole_weights_sum_to_what_is_asked(weights, total):
    got = m.whole_weights(weights, total)
    assert sum(got.values()) == max(total, len(weights)) and min(got.values()) >= 1


def test_weights_are_taken_as_they_are_written():
    assert m.exact_weights({"a": 0.1, "b": 0.3, "c": Fraction(1, 5)}) == {"a": 1, "b": 3, "c": 2}
    assert m.exact_weights({"a": 1, "b": 1, "c": 0.0014}) == {"a": 5000, "b": 5000, "c": 7}
    with pytest.raises(ValueError):
        m.exact_weights({"a": 1, "b": 1e-9})


def test_a_plan_without_bound_is_an_error(monkeypatch):
    monkeypatch.setattr(m, "MOST_PLAN", 1000)
    with pytest.raises(ValueError):
        m.plan_phases({f"s{k}": k + 1 for k in range(100)}, dict.fromkeys((f"s{k}" for k in range(100)), 1))


def test_prefixes_follow_the_weights(spark):
    docs = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(3000)], "doc_id long, source string")
    rows = sorted(m.mix_sources(docs, {"a": 5, "b": 3, "c": 2}, block=8).collect(), key=lambda r: r.position)
    assert len({r.doc_id for r in rows}) == len({r.position for r in rows}) == 3000
    seen = dict.fromkeys("abc", 0)
    for t, r in enumerate(rows[:1900], 1):
        seen[r.source] += 1
        assert all(abs(seen[s] - t * w / 10) < 2 * 8 for s, w in zip("abc", (5, 3, 2), strict=True))


def test_keeps_every_row(docs, odd_docs, no_docs):
    for table in (docs, odd_docs, no_docs):
        got = m.mix_sources(table, block=2)
        assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(map(str, (r.doc_id for r in table.collect())))
        assert got.select("position").distinct().count() == table.count()
    mixed = m.in_mixed_order(docs, block=2)
    assert mixed.columns == docs.columns and sorted(mixed.collect(), key=str) == sorted(docs.collect(), key=str)
    with pytest.raises(ValueError):
        m.mix_sources(docs, {"a": 0})


def furthest(blocks, weights):
    """The most blocks that any source is from its weight's share, up to the slot where the first source runs out."""
    seen, total, worst = dict.fromkeys(blocks, 0), sum(weights.values()), 0
    rows, chunks = m._plan_rows(blocks, m.exact_weights(weights))
    at = {(s, p): [] for s, p, *_ in rows}
    for s, p, _, mine in chunks:
        at[s, p] += mine
    order = sorted((first + c * n + x, s) for s, p, start, stop, k, first, n in rows for c in range((stop - start) // k) for x in at[s, p])
    assert [x for x, _ in order] == list(range(sum(blocks.values())))
    for t, (_, s) in enumerate(order, 1):
        seen[s] += 1
        worst = max(worst, *(abs(seen[x] * total - t * weights[x]) for x in blocks))
        if seen[s] == blocks[s]:
            return worst / total


def test_never_a_block_off_until_a_source_runs_out():
    hot = {"hot": 625} | {f"s{i}": 63 for i in range(20)}
    assert furthest(hot, m.whole_weights({s: n**0.5 for s, n in hot.items()}, m.PARTS)) < 1
    assert furthest({"a": 500, "b": 500}, {"a": 9, "b": 1}) < 1
    assert furthest({"a": 40_000, "b": 40_000, "c": 100}, {"a": 5000, "b": 5000, "c": 7}) < 1
    assert furthest({"a": 7, "b": 5, "c": 1}, {"a": 310, "b": 200, "c": 17}) < 1
    assert furthest({"a": 150_000, "b": 150_000, "c": 150_000}, {"a": 1, "b": 1, "c": 1}) < 1  # more blocks than a cycle may have slots
    assert furthest({"a": 100, "b": 200_000, "c": 200_000}, {"a": 1, "b": 5000, "c": 5000}) < 1
    assert furthest({"a": 400, "b": 100, "c": 100}, {"a": 1, "b": 1, "c": 1}) < 1


def test_plan_of_a_long_table_is_short():
    rows, chunks = m._plan_rows({"a": 10**9, "b": 2 * 10**9, "c": 3 * 10**9}, {"a": 1, "b": 2, "c": 2})
    assert len(rows) <= 12 and sum(len(c[3]) for c in chunks) <= 20


def test_rows_follow_exact_weights(spark):
    docs = spark.createDataFrame([(i, "hot" if i < 10_000 else f"s{i % 20}") for i in range(30_000)], "doc_id long, source string")
    rows = sorted(m.mix_sources(docs).collect(), key=lambda r: r.position)
    weights = m.whole_weights({"hot": 100.0} | {f"s{i}": 1000**0.5 for i in range(20)}, m.PARTS)
    assert len({r.position for r in rows}) == 30_000
    slots, seen = sorted({(r.slot, r.source) for r in rows}), dict.fromkeys(weights, 0)
    for t, (slot, s) in enumerate(slots, 1):
        seen[s] += 1
        assert slot == t - 1 and all(abs(seen[x] * m.PARTS - t * w) < m.PARTS for x, w in weights.items())
        if seen[s] == (625 if s == "hot" else 63):
            break
