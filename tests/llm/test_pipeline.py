from pyspark.sql import functions as F

import corpus_pipeline
from helixframe.llm import credentials, pieces, quality


def test_stages_over_a_small_table(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    now, kept = docs, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, "/root/testdata/sf0.001")
        if k < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        kept[name] = {r.doc_id for r in now.select("doc_id").collect()}
    good = {r.doc_id for r in quality.judge_quality(docs).collect() if r.kept}
    names = list(kept)
    assert kept[names[0]] == good and kept[names[1]] <= good and kept[names[1]] == kept[names[2]] == kept[names[3]] == kept[names[4]]
    ran = {r.doc_id: r for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()}
    assert ran.keys() == kept[names[4]]
    texts = {r.doc_id: r.text for r in credentials.redact_secrets(docs).collect()}
    coder = pieces.Coder(pieces.load_vocabulary())
    for i, r in ran.items():
        assert r.decoded == texts[i] and r.ids == coder.encode(texts[i])


def test_odd_rows_through_all_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    good = quality.judge_quality(docs).filter("kept").select("doc_id").limit(40).collect()
    some = docs.filter(docs.doc_id.isin([r.doc_id for r in good]))
    ids = F.when(F.col("doc_id") % 3 == 0, F.lit(None)).when(F.col("doc_id") % 3 == 1, F.lit(7)).otherwise(F.col("doc_id")).cast("long")
    odd = some.withColumn("doc_id", ids)
    odd = odd.unionByName(odd)
    got = {}
    for name, now in (("plain", some), ("odd", odd)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            at = str(tmp_path / f"{name}{k}")
            stage(spark, now, "/root/testdata/sf0.001").write.parquet(at)
            now = spark.read.parquet(at)
        got[name] = now.select("doc_id", "decoded").collect()
    assert len(got["plain"]) > 10 and sum(r.doc_id is None for r in got["odd"]) > 2
    assert sorted(r.decoded for r in got["odd"]) == sorted(r.decoded for r in got["plain"])


def test_clashing_names_nulls_and_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = ("_key", "_position", "_drop", "_place", "_name", "_seq", "slot", "block", "position", "fp", "shard", "id", "n", "side", "part", "same", "ids", "decoded", "Text_")
    clash = docs
    for k, n in enumerate(names):
        clash = clash.withColumn(n, F.lit(None).cast("string") if k % 2 else F.col("doc_id"))
    nulls = clash.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang"))).withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.col("source"))).withColumn("n_chars", F.lit(None).cast("long"))
    nulls = nulls.withColumn("text", F.when(F.col("doc_id") % 7 > 0, F.col("text")))
    for name, now in (("clash", nulls), ("empty", clash.limit(0))):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, now, "/root/testdata/sf0.001")
            if k < 4:
                assert out.columns == clash.columns
            at = str(tmp_path / f"{name}{k}")
            out.write.parquet(at)
            now = spark.read.parquet(at)
        assert (now.count() > 20) == (name == "clash")
