import re
from collections import Counter
from itertools import permutations

from helixframe.llm import filter_audit as a

LABELS = "doc_id long, quality int, toxic int"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(rows):
    """The filters that each row (id, text, part) fails."""
    texts = [(i, t or "") for i, t, _ in rows]
    for i, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield "".join(
            f for f, bad in zip("ABCDE", (
                len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)),
                any(t == u and j is not None and (i is None or j < i) for j, u in texts),
            ), strict=True) if bad
        )


def plain(rows, good, toxic):
    told = [(part or "", i, f) for (i, _, part), f in zip(rows, fails(rows), strict=True)]
    out = []
    for part in {p for p, _, _ in told}:
        mine = [(i, f) for p, i, f in told if p == part]
        removed, made = Counter(), []
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                removed[f] += len(gone)
                earlier = sum(1 for _, x in mine if f in x and set(x) & set(order[:k]))
                made.append([part, "".join(order), k + 1, len(left), len(gone), earlier, sum(x == f for _, x in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)])
        out += [(*x, removed[x[1][x[2] - 1]]) for x in made]
    return sorted(out)


def check(spark, docs, labels):
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    got = a.audit_filters(docs, spark.createDataFrame(labels, LABELS)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == plain(rows, {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1})
    return got


def test_all_orders(spark, docs):
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in ids if i % 3] + [(None, 1, 1), (999, 1, 1), (ids[0], 1, 0), (ids[0], 0, None)]
    assert len(check(spark, docs, labels)) == 3 * 600


def test_odd_rows(spark, odd_docs, no_docs):
    check(spark, odd_docs.repartition(3), [(10, 1, 1)])
    check(spark, odd_docs.unionByName(odd_docs).unionByName(odd_docs.filter("doc_id IS NULL")).coalesce(1), [])
    assert check(spark, no_docs, []) == []


def test_words_counted_by_row(spark, odd_docs):
    got = {(r.doc_id, r["_words"], r["_distinct"]) for r in a.word_counts(odd_docs).collect()}
    want = {(r.doc_id, len(w), len(set(w))) for r in odd_docs.collect() for w in [re.findall(r"[^\x20\x09-\x0D]+", r.text or "")]}
    assert got == want


def test_a_pile_of_copies(spark):
    """Copies meet the first of their text by its key and not by their text: no task gets them all."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same same', concat('t ', id)) AS text", "if(id % 2 = 0, 'x', 'y') AS lang")
    got = {(r.part, r.filter_order): r for r in a.audit_filters(docs, spark.createDataFrame([], LABELS)).filter("step = 1 AND filter_order LIKE 'E%'").collect()}
    assert sum(r.removed for r in got.values()) == 999 * 24 and len(got) == 48
