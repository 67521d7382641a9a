import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from helixframe.llm import language_id as lid

SF = "/root/testdata/sf0.001"


def plain_trees(texts, order=3):
    """Counts of what follows each context of up to `order` bytes, in a text behind its start."""
    seen = defaultdict(Counter)
    for t in texts:
        b = b"\n" * order + t.lower().encode()
        for i in range(order, len(b)):
            for size in range(order + 1):
                seen[b[i - size : i]][b[i]] += 1
    return seen


def plain_bits(seen, text, order=3):
    """The code length by walking from the longest context to the shortest, byte by byte."""
    b, bits = b"\n" * order + text.lower().encode(), 0.0
    for i in range(order, len(b)):
        gone = set()
        for size in range(order, -1, -1):
            here = {s: n for s, n in seen.get(b[i - size : i], {}).items() if s not in gone}
            if not seen.get(b[i - size : i]):
                continue
            whole = sum(here.values()) + len(here)
            if b[i] in here:
                bits -= math.log2(here[b[i]] / whole)
                break
            if here:
                bits -= math.log2(len(here) / whole)
            gone |= here.keys()
        else:
            bits += math.log2(256 - len(gone))
    return bits


WORDS = {"aa": "der die und nicht schön weg über".split(), "bb": "the and of not way over fine".split(), "cc": "日本 語の 文 です".split()}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "s", "e", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def told():
    rng = random.Random(5)
    return [(lang, prose(rng, lang, rng.randrange(1, 60))) for lang in WORDS for _ in range(20)]


def grown(told, most_cells=lid.MOST_CELLS):
    counts = Counter()
    for lang, t in told:
        b = b"\n" * 3 + t.lower().encode()
        counts.update((lang, int.from_bytes(b[i - 3 : i + 1], "big")) for i in range(3, len(b)))
    keys = sorted(counts)
    return lid.grow(np.array([k[0] for k in keys], object), np.array([k[1] for k in keys], np.uint32), np.array([counts[k] for k in keys], np.int64), most_cells)


def test_code_lengths_are_those_of_a_plain_walk(told):
    trees = grown(told)
    plain = {g: plain_trees([t for lang, t in told if lang == g]) for g in WORDS}
    rng = random.Random(6)
    texts = ["", "a", "ÄÖ", "the", "zzz\x00\x01", "日", "\n\n\n", *[prose(rng, lang, 30) for lang in WORDS], prose(rng, "aa", 5) + prose(rng, "bb", 5)]
    data, bounds = lid.texts_of(pa.array([lid.START + t.lower() for t in texts]))
    got = lid.code_lengths(trees, data, bounds) / lid.UNIT
    for t, row in zip(texts, got, strict=True):
        for g, bits in zip(trees.langs, row, strict=True):
            assert bits == pytest.approx(plain_bits(plain[g], t), abs=1e-4 * (len(t) + 1))


def test_code_lengths_sum_to_a_distribution(told):
    """After any context, what all 256 bytes cost is a probability distribution in each language."""
    trees = grown(told)
    for context in (b"\n\n\n", b"der", b"qqq", b"xde", "本".encode()):
        texts = [context + bytes([s]) for s in range(256)]
        data = np.frombuffer(b"".join(texts), np.uint8)
        bounds = np.arange(257) * 4
        assert np.exp2(-lid.code_lengths(trees, data, bounds) / lid.UNIT).sum(0) == pytest.approx(np.ones(3), abs=1e-3)


def test_pieces_and_slices_change_nothing(told, monkeypatch):
    trees = grown(told)
    texts = pa.array([lid.START + t.lower() for _, t in told])
    data, bounds = lid.texts_of(texts)
    whole = lid.code_lengths(trees, data, bounds)
    data, bounds = lid.texts_of(texts.slice(7, 20))
    assert (lid.code_lengths(trees, data, bounds) == whole[7:27]).all()
    for size in (1, 5, 64, 1000):
        monkeypatch.setattr(lid, "PIECE", size)
        data, bounds = lid.texts_of(texts)
        assert (lid.code_lengths(trees, data, bounds) == whole).all()


def test_smaller_trees_still_code_and_tell(told):
    trees = grown(told, most_cells=3 * 40 * 60)
    assert trees.cost.shape[1] // trees.symbols <= 61
    rng = random.Random(8)
    for lang in WORDS:
        data, bounds = lid.texts_of(pa.array([lid.START + prose(rng, lang, 40)]))
        assert trees.langs[lid.code_lengths(trees, data, bounds)[0].argmin()] == lang


def test_fit_is_that_of_the_texts_and_bounded(spark, told):
    docs = spark.createDataFrame([*told, (None, "left out"), ("aa", None)], "lang string, text string").repartition(3)
    got, want = lid.fit(docs), grown(told)
    assert got.langs == want.langs and (got.cost == want.cost).all() and (got.pair == want.pair).all() and (got.longer == want.longer).all()
    many = docs.crossJoin(spark.range(50).withColumnRenamed("id", "n")).selectExpr("lang", "concat(text, n) AS text")
    few = lid.sample(many, rows=30, chars=9).collect()
    assert max(Counter(r["_lang"] for r in few).values()) == 30 and max(len(r["_text"]) for r in few) == 9
    # copies count once, and what is sampled doesn't depend on how rows are dealt
    assert sorted(lid.sample(many.union(many).repartition(7), rows=30, chars=9).collect()) == sorted(few)


def test_odd_rows(spark, docs, odd_docs, no_docs, told):
    trees = grown(told)
    got = {r.doc_id: r for r in lid.predict(docs.selectExpr("*", "1 AS _coded", "2 AS LANG_PRED"), trees).collect()}
    assert (got[14].lang_pred, got[14].score, got[14].bits_per_byte) == ("und", 0.0, None)  # empty
    assert got[15].lang_pred == got[16].lang_pred == "und"  # null, white space
    assert got[20].lang_pred == "cc" and got[10].lang_pred == got[11].lang_pred and got[10].fp == "x" and got[10]["_coded"] == 1
    assert lid.predict(odd_docs, trees).count() == odd_docs.count()
    assert lid.predict(no_docs, trees).count() == 0
    none = lid.fit(no_docs)
    assert none.langs == [] and {(r.lang_pred, r.score) for r in lid.predict(docs, none).collect()} == {("und", 0.0)}


def test_registered_query(spark):
    from helixframe.llm import queries

    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op11_languages(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.97
    # brute force: the whole learned part is within the sample's bound of rows, texts are cut to its bound of characters
    learned = defaultdict(set)
    for r in docs.values():
        if r.lang and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            learned[r.lang].add(r.text[: lid.SAMPLE_CHARS])
    plain = {g: plain_trees(t) for g, t in learned.items()}
    for r in held[:12]:
        bits = {g: plain_bits(p, docs[r.doc_id].text[:500]) for g, p in sorted(plain.items())}
        assert r.lang_pred == min(bits, key=bits.get)
