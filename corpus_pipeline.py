"""From raw documents to token ids: quality, exact and near duplicates, leaks, BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep
the columns of `documents`. `run` writes each stage as Parquet in the shared folder and
rereads it, so a lost executor costs at most the tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm import bpe, decontaminate, exact_dedup, quality, simhash_dedup
from turnloom.llm.common import table, written
from turnloom.llm.queries import vocabulary


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on these documents and `labels`, accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup.keep_one_of_equal_texts(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest id."""
    return simhash_dedup.keep_one_of_each_component(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and input_ids of each document."""
    encoded = bpe.encode_documents(docs, vocabulary("byte_bpe_50k.json"))
    return encoded.select(
        F.col("id").alias("doc_id"), F.size("input_ids").cast("long").alias("n_tokens"), "input_ids"
    )


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("simhash_dedup", without_near_copies),
    ("decontaminate", without_leaks),
    ("bpe", as_tokens),
]

# Training a network and fingerprints of 64-bit hashes are not expressible in the SQL engine.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
