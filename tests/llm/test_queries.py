"""The registered text queries and the pipeline on the smallest provided tables."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare, connect
from ledgerwell.llm.queries import ORACLE, QUERIES
from ledgerwell.llm.shared import documents, stage

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the provided tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name, QUERIES[name], ORACLE[name]) is None


def test_pipeline_stages(spark):
    docs = documents(spark, SF_DIR)
    columns = docs.columns
    for name, work in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(work(spark, docs, SF_DIR), "test")
        assert docs.columns == columns and docs.count() > 0, name
        assert docs.select("doc_id").exceptAll(before.select("doc_id")).distinct().join(before, "doc_id", "left_anti").count() == 0
    assert docs.where(F.length("text") != F.col("n_chars")).count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
