"""A corpus pipeline: quality rules, near-dedup, secret scans, mixing, encoding. Each stage works on what the one before kept.

In all stages nulls may be in any column, ids may repeat, extra columns may have any name, texts may be empty or very
long, and the table may be empty; each docstring says what becomes of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import credentials, mixing, pieces, quality, simhash
from helixframe.llm.common import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the bands of their language; null, empty and short texts go, each repeated row is judged."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the least id, of each class of texts with a likeness of 0.8 or more over five-word shingles.

    Rows with null or repeated ids are compared by their texts like any others; a null id comes last.
    """
    return simhash.drop_near_copies(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with `[secret]` in the place of each secret of the text, and n_chars as long as that; null texts stay null."""
    return credentials.redact_secrets(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, laid out in mixed order of their sources; a null source is one, and equal rows are in any order."""
    return mixing.in_mixed_order(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, piece ids and the text that they give back, of all rows; a null text has null ids, an empty one none."""
    return pieces.encode_documents(docs, keep=("doc_id", "source"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mixing),
    ("SentencePiece encoding and decoding", piece_encoding),
]

#: SQL can't express the measures of a tokenizer, trained models or a Viterbi search.
ORACLE_SQL = None


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet in the shared folder and reread as the next one's docs.

    A stage's folder is removed once the next one's is written; the last one stays, as the result is read from it.
    """
    at = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            out.write.parquet(f"{at}/{k}")
            docs = spark.read.parquet(f"{at}/{k}")
            if k:
                _remove(spark, f"{at}/{k - 1}")
    return out
