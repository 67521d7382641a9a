import zlib
from collections import Counter, defaultdict

from helixframe.llm import sharding as s


def check(table, rows, shards):
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in table.collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_rows(docs, odd_docs, no_docs, texts):
    rows = s.assign_shards(docs).collect()
    check(docs, rows, 16)
    where = defaultdict(set)
    for r in rows:
        t = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(t) + 1 and r.text_crc32 == zlib.crc32(t)
        where[t].add(r.shard)
    assert all(len(x) == 1 for x in where.values())
    check(odd_docs, s.assign_shards(odd_docs, shards=3).collect(), 3)
    assert s.assign_shards(no_docs).count() == 0


def test_near_equal_sizes_as_whole_heap_gives(spark):
    docs = spark.createDataFrame([(i, chr(97 + i % 26) * (1 + i * 7919 % 900) + str(i // 2)) for i in range(4000)], "doc_id long, text string")
    for bins in (16_384, 300):
        rows = s.assign_shards(docs, shards=8, bins=bins).collect()
        check(docs, rows, 8)
        load = Counter()
        for r in rows:
            load[r.shard] += r["size"]
        assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values()) / 8


def test_longest_first():
    assert s.longest_first({("a",): 5, ("b",): 4, ("c",): 3, ("d",): 3, ("e",): 3}, 2) == {("a",): 0, ("b",): 1, ("c",): 1, ("d",): 0, ("e",): 1}
