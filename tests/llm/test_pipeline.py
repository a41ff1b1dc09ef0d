"""Every stage of the pipeline on its own input, and the registered queries."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver
import compare
import corpus_pipeline
from turnloom.llm import decontaminate, exact_dedup, simhash_dedup
from turnloom.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_queries_are_registered():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    actual = QUERIES[name](spark, SF_DIR).toPandas()
    assert compare.differences(actual, con.execute(ORACLES[name]).df()) == ""


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR))
        assert docs.columns == columns
        after = docs.count()
        assert 0 < after <= before, name
        before = after
    assert docs.select("text").distinct().count() == before == docs.select("doc_id").distinct().count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.count() == before and last.filter("n_tokens <> size(input_ids)").count() == 0


def test_stages_take_any_extra_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    names = ("_leak", "_gone", "_id0", "id", "n", "hashes", "fp")
    extra = docs.selectExpr("*", *[f"1 AS {name}" for name in names])
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    for stage in (lambda d: decontaminate.drop_leaks(d, items), simhash_dedup.keep_one_of_each_component, exact_dedup.keep_one_of_equal_texts):
        kept = stage(extra)
        assert kept.columns == extra.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in stage(docs).collect())
