import hashlib
import re

import pytest
from pyspark.sql import functions as F

from helixframe.llm import fingerprints as f


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(texts):
    ids = sorted(texts, reverse=True)
    for k, i in enumerate(ids):
        own, nxt = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        half = len(own) // 2
        yield i, own[: len(own) - half] + nxt[:half], nxt


def test_against_brute_force(docs, texts):
    got = {r.doc_id: r for r in f.compare_with_edits(docs).collect()}
    assert got.keys() == texts.keys()
    for i, changed, nxt in edited(texts):
        r, own = got[i], texts[i] or ""
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(shingles(own), shingles(changed))) < 0.15
        assert abs(r.near_next - jaccard(shingles(own), shingles(nxt))) < 0.15
        n = len(shingles(own))
        assert abs(r.n_shingles - n) <= 0.3 * n
        if n < f.K:  # whole sets: exact
            assert r.n_shingles == n and len(r.sketch) == n
    assert got[10].sketch == got[11].sketch != got[12].sketch


@pytest.mark.parametrize("rows", [1, 2, 7, 50])
def test_next_row_over_many_buckets(spark, rows):
    docs = spark.createDataFrame([(i * i, f"t{i} " * (i % 5)) for i in range(rows)], "doc_id long, text string")
    dealt, own, order = f.with_next(docs.select("doc_id", F.col("text").alias("_text")), "doc_id", rows_per_bucket=3)
    got = {r.doc_id: r.n for r in dealt.withColumn("n", F.lead("doc_id").over(order)).filter(own).collect()}
    ids = sorted(got, reverse=True)
    assert got == {i: ids[(k + 1) % len(ids)] for k, i in enumerate(ids)}


def test_repeated_rows_null_keys_and_empty_tables(odd_docs, no_docs):
    assert f.compare_with_edits(odd_docs).count() == odd_docs.count()
    assert f.compare_with_edits(no_docs).count() == 0
    assert f.sketch_documents(no_docs).count() == 0


def test_sketches_merge_and_contain(spark):
    whole = " ".join(f"x{i}" for i in range(900))
    parts = [(1, " ".join(f"x{i}" for i in range(a, min(900, a + 304)))) for a in range(0, 900, 300)]
    sketched = f.sketch_documents(spark.createDataFrame([*parts, (2, None)], "doc_id long, text string"))
    one = f.sketch_documents(spark.createDataFrame([(1, whole)], "doc_id long, text string")).first()
    merged = {r.doc_id: r.sketch for r in f.merge_parts(sketched, "doc_id").collect()}
    assert merged == {1: one.sketch, 2: []}
    pair = spark.createDataFrame([(one.sketch, sketched.filter("doc_id = 1").first().sketch)], "a array<bigint>, b array<bigint>")
    r = pair.select(f.containment(F.col("b"), F.col("a")).alias("c"), f.resemblance(F.col("a"), F.col("b")).alias("j")).first()
    assert r.c > 0.8 and 0.2 < r.j < 0.5
