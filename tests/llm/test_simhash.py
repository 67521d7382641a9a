import random
import re

import numpy as np
import pytest
import xxhash

from helixframe.llm import simhash as s


def fingerprint(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius):
    """The least id reachable, by comparing all pairs."""
    up = {i: i for i in fps}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: find(i) for i in fps}


def test_against_brute_force(docs, texts):
    got = {r.doc_id: r for r in s.near_duplicates(docs).collect()}
    fps = {i: fingerprint(t) for i, t in texts.items()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == components(fps, 2)
    assert got[14].fingerprint == got[15].fingerprint == "0" * 16 and got[16].component_id == 14


@pytest.mark.parametrize("radius", [1, 2])
@pytest.mark.parametrize("most", [1000, 3])  # one tree a shard, or shards that are too large for one
def test_links_of_close_fingerprints(spark, radius, most):
    rng = random.Random(radius)
    centres = [rng.getrandbits(64) for _ in range(12)]
    fps = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (1 << 64) - 1 for c in centres for _ in range(15)} | {0, 1, (1 << 64) - 1}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    tops = {r.fp: r.top for r in s.classes_of(s.links(frame, radius, most)).collect()}
    ids = {i: x for i, x in enumerate(sorted(fps, key=signed))}
    want = components(ids, radius)
    assert {x: tops.get(signed(x), signed(x)) for x in fps} == {ids[i]: signed(ids[t]) for i, t in want.items()}


def test_long_chains_settle(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    tops = {r.fp: r.top for r in s.classes_of(edges).collect()}
    assert tops == {**{i: 0 for i in range(1, 201)}, 501: 500}


def test_tree_finds_what_comparing_all_finds():
    rng = random.Random(1)
    fps = [rng.getrandbits(12) for _ in range(300)]
    tree, kept = s.BKTree(), []
    for fp in fps:
        assert sorted(tree.within(fp, 2)) == sorted({x for x in kept if (x ^ fp).bit_count() <= 2})
        tree.add(fp, 2)
        kept.append(fp)


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_copies_of_a_planted_corpus(spark):
    rng = random.Random(5)
    text, source = {}, {}
    for i in range(150):
        base = [f"v{rng.randrange(2000)}" for _ in range(rng.randrange(60, 400))]
        text[10 * i] = " ".join(base)
        for k in range(1, rng.randrange(1, 6)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 60))):
                copy[rng.randrange(len(copy))] = "changed"
            text[10 * i + k], source[10 * i + k] = " ".join(copy), 10 * i
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string").repartition(6)
    for most in (512, 12):
        classes = {r.doc_id: r.component_id for r in s.near_copy_classes(docs, tree_most=most).collect()}
        sure = [k for k, o in source.items() if len(shingle_set(text[k]) & shingle_set(text[o])) >= 0.8 * len(shingle_set(text[k]) | shingle_set(text[o]))]
        assert len(sure) > 100 and sum(classes[k] // 10 == k // 10 and classes[k] != k for k in sure) >= 0.97 * len(sure)
        assert all(c // 10 == k // 10 for k, c in classes.items())
    kept = {r.doc_id for r in s.drop_near_copies(docs).collect()}
    assert {10 * i for i in range(150)} <= kept


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"v{rng.randrange(3000)}" for _ in range(300)]
    rows = []
    for i in range(400):
        copy = list(base)
        copy[rng.randrange(300)] = f"new{i}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for most in (512, 60):
        classes = {r.doc_id: r.component_id for r in s.near_copy_classes(docs, tree_most=most).collect()}
        assert set(classes.values()) == {0} and len(classes) == 400


def test_near_copy_stage_keeps_columns_and_odd_rows(docs, odd_docs, no_docs):
    kept = s.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 10 in ids and not ids & {11, 24} and 13 in ids
    odd = [r.doc_id for r in s.drop_near_copies(odd_docs).collect()]
    assert odd.count(None) == 1 and odd.count(10) == 1
    assert s.drop_near_copies(no_docs).count() == 0 and s.near_duplicates(no_docs).count() == 0
    assert s.near_duplicates(odd_docs).count() == odd_docs.count()


def test_likeness_of_sets():
    a, b = np.arange(100, dtype="<u8"), np.arange(20, 120, dtype="<u8")
    assert s.likeness(a, b) == 80 / 120 and s.likeness(a[:0], b[:0]) == 1.0 and s.likeness(a, b[:0]) == 0.0


def test_near_copies_that_repeat_a_passage_unlike_often(spark):
    rng = random.Random(11)
    text = {}
    for i in range(40):
        base, passage = [f"u{rng.randrange(5000)}" for _ in range(120)], [f"p{rng.randrange(5000)}" for _ in range(12)]
        copy = list(base)
        copy[60] = "changed"
        text[2 * i], text[2 * i + 1] = " ".join(base + passage * 8), " ".join(copy + passage)
    sure = [k for k in range(0, 80, 2) if len(shingle_set(text[k]) & shingle_set(text[k + 1])) >= 0.85 * len(shingle_set(text[k]) | shingle_set(text[k + 1]))]
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string")
    classes = {r.doc_id: r.component_id for r in s.near_copy_classes(docs).collect()}
    assert len(sure) == 40 and sum(classes[k + 1] == k for k in sure) >= 39


def crowd(rng, n, template):
    """n pairs of near copies; all texts share a template of 180 words, which is 60 % of each."""
    text = {}
    for i in range(n):
        base = [f"u{rng.randrange(10**6)}" for _ in range(120)]
        text[2 * i] = " ".join(template + base)
        for at in (20, 50, 80, 110):
            base[at] = f"x{i}"
        text[2 * i + 1] = " ".join(template + base)
    return text


def test_pairs_in_a_crowd_over_the_limit(spark):
    rng = random.Random(21)
    text = crowd(rng, 600, [f"t{rng.randrange(10**6)}" for _ in range(180)])
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string").repartition(4)
    sets = {i: shingle_set(t) for i, t in text.items()}
    assert all(len(sets[k] & sets[k + 1]) >= 0.8 * len(sets[k] | sets[k + 1]) for k in range(0, 1200, 2))
    whole = {r.doc_id: r.component_id for r in s.near_copy_classes(docs, tree_most=8192).collect()}
    dealt = {r.doc_id: r.component_id for r in s.near_copy_classes(docs, tree_most=40).collect()}
    assert dealt == whole and sum(dealt[k + 1] == k for k in range(0, 1200, 2)) >= 590


def test_a_crowd_that_shares_most_of_its_text_loses_no_pair(spark):
    """At default settings: texts of 200 words of which all share 165, so that unlike ones have a likeness of about 0.7."""
    rng = random.Random(17)
    template, text = [f"t{rng.randrange(10**6)}" for _ in range(165)], {}
    for i in range(2500):
        own = [f"u{rng.randrange(10**6)}" for _ in range(35)]
        text[2 * i] = " ".join(template + own)
        own[20] = f"x{i}"
        text[2 * i + 1] = " ".join(template + own)
    sets = {i: shingle_set(text[i]) for i in range(0, 40)}
    assert all(len(sets[k] & sets[k + 1]) >= 0.9 * len(sets[k] | sets[k + 1]) for k in range(0, 40, 2))
    assert all(0.6 < len(sets[a] & sets[b]) / len(sets[a] | sets[b]) < 0.75 for a in range(0, 40, 2) for b in range(a + 2, 40, 2))
    classes = {r.doc_id: r.component_id for r in s.near_copy_classes(spark.createDataFrame(list(text.items()), "doc_id long, text string").repartition(4)).collect()}
    assert len(classes) == 5000 and all(classes[k] == classes[k + 1] == k for k in range(0, 5000, 2))


@pytest.mark.parametrize("seed", range(4))
def test_common_counts_of_sets(seed):
    rng = np.random.default_rng(seed)
    template = rng.integers(0, 1 << 32, 50 * seed).astype("<u4")
    make = lambda n: [np.unique(np.concatenate([rng.choice(template, len(template) // 2) if len(template) else template, rng.integers(0, 400, rng.integers(0, 30)).astype("<u4")])) for _ in range(n)]
    left, right = make(40), make(25)
    assert (s.common_counts(left, right) == [[len(np.intersect1d(x, y)) for y in right] for x in left]).all()
    assert (s.alike(left, right, 0.8) == [[s.likeness(x, y) >= 0.8 for y in right] for x in left]).all()
    assert s.alike(left[:1], [left[0][:0]], 0.8).tolist() == [[len(left[0]) == 0]] and s.common_counts([], right).shape == (0, 25)


def test_crossed_parts_compare_every_pair():
    rng = np.random.default_rng(2)
    bases = [rng.integers(0, 1 << 32, 60).astype("<u4") for _ in range(6)]
    made = []
    for i in range(60):
        mine = np.unique(np.concatenate([bases[i % 6][4:], rng.integers(0, 1 << 32, 4).astype("<u4")]))
        made.append((i, s.wide_simhash(mine.astype("<u8")), mine))
    left, right = made[:25], made[25:]
    up = s.Classes()
    for a, b in s.crossed_links(left, right, 128, 0.8):
        up.join(a, b)
    want = s.Classes()
    for i, _, x in left:
        for j, _, y in right:
            if s.likeness(x, y) >= 0.8:
                want.join(i, j)
    assert [up.find(i) for i in range(60)] == [want.find(i) for i in range(60)]
    assert 1 < len({want.find(i) for i in range(60)}) < 60


def test_long_texts_are_decided_on_whole_sets(spark):
    rng = random.Random(31)
    text = {}
    for i in range(60):
        base = [f"u{rng.randrange(10**6)}" for _ in range(1200)]
        copy = list(base)
        for k in range(29 - 4 * (i % 2)):  # likeness just under, or just over, 0.8
            copy[20 + 40 * k] = f"x{k}"
        text[2 * i], text[2 * i + 1] = " ".join(base), " ".join(copy)
    sets = {i: shingle_set(t) for i, t in text.items()}
    likeness = {k: len(sets[k] & sets[k + 1]) / len(sets[k] | sets[k + 1]) for k in range(0, 120, 2)}
    classes = {r.doc_id: r.component_id for r in s.near_copy_classes(spark.createDataFrame(list(text.items()), "doc_id long, text string")).collect()}
    joined = {k: classes[k + 1] == k for k in likeness}
    assert {likeness[k] >= 0.8 for k in likeness} == {True, False} and all(0.77 < x < 0.83 for x in likeness.values())
    assert not any(joined[k] for k in likeness if likeness[k] < 0.8)
    assert sum(joined[k] for k in likeness if likeness[k] >= 0.8) >= 29


def test_tiles_and_parts_change_no_link(monkeypatch):
    rng = np.random.default_rng(4)
    bases = [np.unique(rng.integers(0, 1 << 32, 200 * (k + 1)).astype("<u4")) for k in range(8)]
    made = []
    for i in range(160):
        base = bases[i % 8]
        mine = np.unique(np.concatenate([rng.permutation(base)[: int(len(base) * rng.uniform(0.8, 1))], rng.integers(0, 1 << 32, len(base) // 20).astype("<u4")]))
        made.append((i, s.wide_simhash(mine.astype("<u8")), mine))

    def classes(links):
        up = s.Classes()
        for a, b in links:
            up.join(a, b)
        return [up.find(i) for i in range(160)]

    want = [(j, i) for i in range(160) for j in range(i) if s.likeness(made[i][2], made[j][2]) >= 0.8]
    for tile, hashes, few in ((1024, 1 << 20, 32), (7, 1 << 20, 32), (1024, 900, 32), (1024, 1 << 20, 1000)):
        monkeypatch.setattr(s, "TILE", tile)
        monkeypatch.setattr(s, "TILE_HASHES", hashes)
        monkeypatch.setattr(s, "FEW", few)
        assert classes(s.own_links(made, 256, 0.8)) == classes(want)
        assert classes(s.own_links(made[:70], 256, 0.8) + s.own_links(made[70:], 256, 0.8) + s.crossed_links(made[:70], made[70:], 256, 0.8)) == classes(want)
    assert len(set(classes(want))) < 160


def test_parts_by_hashes_lose_no_pair(spark, monkeypatch):
    rng = random.Random(41)
    template, text = [f"t{rng.randrange(10**6)}" for _ in range(1500)], {}
    for i in range(30):
        own = [f"u{rng.randrange(10**6)}" for _ in range(500)]
        text[2 * i] = " ".join(template + own)
        own[250] = f"x{i}"
        text[2 * i + 1] = " ".join(template + own)
    monkeypatch.setattr(s, "PART_HASHES", 20_000)
    classes = {r.doc_id: r.component_id for r in s.near_copy_classes(spark.createDataFrame(list(text.items()), "doc_id long, text string")).collect()}
    assert all(classes[2 * i] == classes[2 * i + 1] == 2 * i for i in range(30))
