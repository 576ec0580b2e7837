"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F
from comparison import difference, oracle_connection

from __spark_entry__ import entry, oracle_sql, queries
from lexispan.plans.catalogue import ORACLES, QUERIES
from lexispan.sources import tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_query_gives_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_only_learned_models_lack_sql():
    assert ROWS_ONLY == [
        "logreg_fit", "model_comparison", "svm_bigram", "svm_fit", "svm_pos_bigram", "svm_trigram"]
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", ["top_words_per_corpus", "clean_text", "token_offsets", "qa_raw_scores"])
def test_large_tables_are_read_as_they_lie(spark, monkeypatch, name):
    spread = queries()[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "RepartitionByExpression [doc_id" in spread or "Repartition" in spread
    monkeypatch.setattr(tables, "MAX_SPREAD_BYTES", 0)
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "REPARTITION" not in plan


def test_rows_are_spread_where_one_split_has_most(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    rows.repartition(spark.sparkContext.defaultParallelism).write.parquet(str(tmp_path / "many"))
    one = tables.scan(spark, str(tmp_path / "one"), "doc_id", spread_by="doc_id")
    many = tables.scan(spark, str(tmp_path / "many"), "doc_id", spread_by="doc_id")
    assert one.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert "REPARTITION" not in many._jdf.queryExecution().toString()
    assert sorted(r.doc_id for r in one.collect()) == list(range(1000))
    spark.range(0).select(F.col("id").alias("doc_id")).write.parquet(str(tmp_path / "none"))
    assert tables.scan(spark, str(tmp_path / "none"), spread_by="doc_id").collect() == []


def test_entry(spark):
    assert entry(spark).columns == ["label", "rank", "word", "cnt"]
