import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helixframe.llm import merkle as m


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain_tree(nodes):
    tree = [nodes]
    while len(tree[-1]) > 1:
        tree.append([h("".join(tree[-1][i : i + 16])) for i in range(0, len(tree[-1]), 16)])
    return tree


def others(tree, i):
    out = []
    for level in tree[:-1]:
        run = i // 16 * 16
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 16])))
        i //= 16
    return out


def plain(rows):
    """(key, leaf): (subroot, root, proof, folded root) of rows (key, group, leaf, claimed), one tree after the other."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([r[2] for r in groups[g]]) for g in order}
    top = plain_tree([trees[g][-1][0] for g in order])
    out = Counter()
    for p, g in enumerate(order):
        for i, (key, _, leaf, claimed) in enumerate(groups[g]):
            proof, folded = others(trees[g], i) + others(top, p), claimed
            for left, right in proof:
                folded = h(left + folded + right)
            out[key, leaf, trees[g][-1][0], top[-1][0], h("".join(a + b for a, b in proof)), folded, folded == top[-1][0]] += 1
    return out


def got(leaves, **limits):
    rows = m.manifest(leaves, "id", "g", **limits).withColumn("proof", m.proof_digest(F.col("proof"))).collect()
    return Counter((r.id, r.leaf, r.subroot, r.root, r.proof, r.folded_root, r.verified) for r in rows)


SCHEMA = "id long, g string, leaf string, claimed string, other int"


def leaves(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(6)


@pytest.mark.parametrize("limits", [{}, {"powers": (1, 2), "few": 30}, {"powers": (1,)}, {"powers": (3,)}])
def test_as_one_tree_after_the_other(spark, limits):
    rows = [(i, g, h(f"{g}{i}"), h(f"{g}{i}" + "x" * (i % 7 == 0))) for g, n in (("a", 1), ("b", 16), ("c", 17), ("é", 700), (None, 257), ("", 5), ("Z", 4200)) for i in range(n)]
    assert got(leaves(spark, rows), **limits) == plain(rows)


def test_many_groups_make_a_tree_above(spark):
    rows = [(i, f"g{i % 300}", h(str(i)), h(str(i))) for i in range(900)]
    found = got(leaves(spark, rows))
    assert found == plain(rows) and all(k[-1] for k in found)


def test_null_and_equal_keys_and_no_rows(spark):
    rows = [(None, "a", h("1"), h("1")), (None, "a", h("2"), h("2")), (3, "a", h("3"), h("!")), (3, "a", h("3"), h("3")), (3, "a", h("4"), h("4")), (3, None, h("4"), h("4"))] * 3
    found = got(leaves(spark, rows))
    assert Counter((k[0], k[1], k[-1]) for k in found.elements()) == Counter((r[0], r[2], r[2] == r[3]) for r in rows)
    assert Counter((k[0], k[1], k[4]) for k in found.elements()) == Counter((k[0], k[1], k[4]) for k in plain(rows).elements())
    assert len({k[3] for k in found}) == 1
    assert got(spark.createDataFrame([], SCHEMA)) == Counter()


def test_one_leaf_alone(spark):
    (key,) = got(leaves(spark, [(1, "a", h("1"), h("1"))]))
    assert key == (1, h("1"), h("1"), h("1"), h(""), h("1"), True)


def test_too_many_blocks_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(m, "MOST_BLOCKS", 3)
    with pytest.raises(ValueError, match="more than 3 blocks"):
        m.manifest(leaves(spark, [(i, f"g{i}", h("1"), h("1")) for i in range(4)]), "id", "g")
    monkeypatch.setattr(m, "MOST_BLOCKS", 10)
    monkeypatch.setattr(m, "MOST_BYTES", 100)
    with pytest.raises(ValueError, match="over 100 bytes"):
        m.manifest(leaves(spark, [(i, f"g{i}", h("1"), h("1")) for i in range(4)]), "id", "g")


def test_leaf_fields(spark, docs):
    got = {r.doc_id: r.leaf for r in docs.select("doc_id", m.leaf_of([F.col("doc_id"), F.col("source"), F.col("text")]).alias("leaf")).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.text)))
