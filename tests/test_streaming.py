import duckdb

from helixframe.operators import junctions as batch
from helixframe.streaming import counters, junctions as stream


def test_running_merge_is_the_merge_of_all_files(spark, tmp_path):
    rows = [("c", str(s), str(s + 60), "+", m, 0, 3, 1, 10 * m, f, k) for f in range(3) for k, (s, m) in enumerate([(1, f + 1), (5 + f, 2), (1, 9)])]
    for f in range(3):
        spark.createDataFrame([r for r in rows if r[9] == f], stream.SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = stream.write_stream(stream.running_merge(stream.read_stream(spark, str(tmp_path / "in"))), "merged_junctions", str(tmp_path / "state"))
    q.awaitTermination(120)
    whole = batch.merge(spark.createDataFrame(rows, stream.SCHEMA), ["file_ord", "at"])
    got = spark.table("merged_junctions")
    assert sorted(map(str, got.select(*whole.columns).collect())) == sorted(map(str, whole.collect())) and got.count() == 1


def test_counts_of_three_batches_are_those_of_all_files(spark, tmp_path):
    rows = [("c", str(s), str(s + 60), "+", 1, s % 3 == 0, s, 1, 9, f, s) for f in range(3) for s in range(50 * (f + 1))]
    for f in range(3):
        spark.createDataFrame([(*r[:5], int(r[5]), *r[6:]) for r in rows if r[9] == f], stream.SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    told = counters.StreamCounters()
    spark.streams.addListener(told)
    try:
        q = stream.write_stream(stream.running_merge(stream.read_stream(spark, str(tmp_path / "in"), files=1)), "counted_junctions", str(tmp_path / "state"))
        q.awaitTermination(120)
        sums = told.sums(q)
    finally:
        spark.streams.removeListener(told)
    n, annotated, coverage = duckdb.connect().execute(f"SELECT count(*), count(*) FILTER (WHERE annotated = 1), sum(coverage)::BIGINT FROM '{tmp_path}/in/*.parquet'").fetchone()
    assert sums == {"junctions": {"n_rows": n, "n_annotated": annotated, "coverage": coverage}} and n == len(rows)
    assert q.lastProgress["batchId"] == 2
