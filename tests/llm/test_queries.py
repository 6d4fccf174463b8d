"""Every text query against its SQL, and the pipeline's contract, on the smallest tables."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import pytest
from compare import connect, difference

from vigilmart.llm.catalog import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None


def test_every_number_has_one_query():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")]
    assert sorted(numbers) == list(range(1, 14))
    assert "pipeline" in QUERIES


def test_entry_points_hold_the_text_queries():
    import __spark_entry__ as points

    assert set(QUERIES) <= set(points.queries())
    assert set(ORACLES) <= set(points.oracle_sql())


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= before
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert len(last) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in last:
        assert row["decoded_sha256"] == hashlib.sha256((texts[row["doc_id"]] or "").encode()).hexdigest()


def test_pipeline_over_an_empty_table(spark, docs, tmp_path):
    docs((1, "a")).where("doc_id < 0").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
