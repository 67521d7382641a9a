"""Views of the test tables in the shapes that the operators take, for Spark and (as common table expressions) for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


JUNCTION_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('chr', l_returnflag) chr", "l_partkey % 100 start", "l_partkey % 100 + cast(l_quantity as bigint) * 4 `end`", "l_linestatus strand", "l_suppkey % 7 motif", "if(l_linenumber = 1, 1, 0) annotated", "cast(l_quantity as bigint) coverage", "cast(l_linenumber as bigint) multimap", "l_suppkey % 60 overhang", *JUNCTION_ORDER,
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr("concat('doc', doc_id) chrom", "regexp_replace(text, '[^ACGTNacgtn]+', '') seq")


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("l_returnflag chrom", "if(l_linestatus = 'O', '+', '-') strand", "l_partkey * 100 start", "l_partkey * 100 + cast(l_quantity as bigint) * 4 `end`")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_type chrom", "event_id pos", "if(user_id % 2 = 0, '+', '-') strand", "if(event_id % 2 = 0, 'D', 'A') site", "cast(value / 490.02 as float) score", "element_at(array('GT', 'AG', 'GC', 'AT'), cast(user_id % 4 as int) + 1) motif"
    )


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known sites: every third, and those that score too little."""
    all_sites = sites(spark, sf_dir)
    return all_sites.filter((F.col("pos") % 3 == 0) | ~(F.col("score") >= F.lit(0.001).cast("float"))).drop("score")


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq_id, window_start, pos and value: each embedding is a window's prediction over its label's sequence."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("seq_id"), ((F.col("vec_id") % 8) * 10).alias("window_start"), F.posexplode("embedding").alias("i", "v"))
    return rows.select("vec_id", "seq_id", (F.col("window_start") + F.col("i")).alias("pos"), F.col("i"), F.col("v").alias("score"), F.col("v").cast("double").alias("value"))


BLOCK_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = Window.partitionBy("l_orderkey")
    along = chain.orderBy(*BLOCK_ORDER)
    rows = table(spark, sf_dir, "lineitem").withColumn("block_no", F.row_number().over(along)).withColumn("_last", F.lead("l_orderkey").over(along).isNull())
    gap = lambda c: F.when(~F.col("_last"), F.col(c) % 120)
    return rows.select(F.col("l_orderkey").alias("chain_id"), "block_no", F.col("l_quantity").cast("bigint").alias("size"), gap("l_partkey").alias("dt"), gap("l_suppkey").alias("dq"))


SQL = {
    "junctions": """junctions AS (SELECT 'chr' || l_returnflag AS chr, l_partkey % 100 AS start, l_partkey % 100 + CAST(l_quantity AS BIGINT) * 4 AS "end", l_linestatus AS strand, l_suppkey % 7 AS motif,
        CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS annotated, CAST(l_quantity AS BIGINT) AS coverage, CAST(l_linenumber AS BIGINT) AS multimap, l_suppkey % 60 AS overhang, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem)""",
    "sequences": "sequences AS (SELECT 'doc' || doc_id AS chrom, regexp_replace(text, '[^ACGTNacgtn]', '', 'g') AS seq FROM documents)",
    "intervals": """intervals AS (SELECT l_returnflag AS chrom, CASE l_linestatus WHEN 'O' THEN '+' ELSE '-' END AS strand, l_partkey * 100 AS start, l_partkey * 100 + CAST(l_quantity AS BIGINT) * 4 AS "end" FROM lineitem)""",
    "sites": """sites AS (SELECT event_type AS chrom, event_id AS pos, CASE WHEN user_id % 2 = 0 THEN '+' ELSE '-' END AS strand, CASE WHEN event_id % 2 = 0 THEN 'D' ELSE 'A' END AS site, CAST(value / 490.02 AS FLOAT) AS score,
        CASE user_id % 4 WHEN 0 THEN 'GT' WHEN 1 THEN 'AG' WHEN 2 THEN 'GC' ELSE 'AT' END AS motif FROM events)""",
    "annotated": "annotated AS (SELECT chrom, pos, strand, site, motif FROM sites WHERE pos % 3 = 0 OR NOT (score >= CAST(0.001 AS FLOAT)))",
    "tracks": "tracks AS (SELECT vec_id, CAST(label AS BIGINT) AS seq_id, (vec_id % 8) * 10 + i AS pos, i, embedding[i + 1] AS score, CAST(embedding[i + 1] AS DOUBLE) AS value FROM (SELECT *, unnest(range(0, 64)) AS i FROM embeddings))",
    "blocks": """blocks AS (SELECT l_orderkey AS chain_id, row_number() OVER w AS block_no, CAST(l_quantity AS BIGINT) AS size, CASE WHEN lead(l_orderkey) OVER w IS NOT NULL THEN l_partkey % 120 END AS dt, CASE WHEN lead(l_orderkey) OVER w IS NOT NULL THEN l_suppkey % 120 END AS dq
        FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate))""",
    "merged": """expanded AS (SELECT DISTINCT chrom, strand, start, "end" FROM intervals),
        marked AS (SELECT *, CASE WHEN start >= max("end") OVER (PARTITION BY chrom, strand ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) OR row_number() OVER (PARTITION BY chrom, strand ORDER BY start, "end") = 1 THEN 1 ELSE 0 END AS fresh FROM expanded),
        islands AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom, strand ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM marked),
        merged AS (SELECT chrom, strand, min(start) AS start, max("end") AS "end" FROM islands GROUP BY chrom, strand, island)""",
    "genome_counts": """pairs AS (SELECT upper(substr(seq, CAST(i AS INT), 2)) AS pair FROM (SELECT seq, unnest(range(1, length(seq))) AS i FROM sequences WHERE length(seq) >= 2)),
        genome_counts AS (SELECT motif, CAST(sum(n) AS BIGINT) AS n FROM (SELECT pair AS motif, count(*) AS n FROM pairs WHERE pair NOT LIKE '%N%' GROUP BY pair UNION ALL SELECT translate(reverse(pair), 'ACGT', 'TGCA'), count(*) FROM pairs WHERE pair NOT LIKE '%N%' GROUP BY pair) GROUP BY motif)""",
}


def with_views(*names: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n"
