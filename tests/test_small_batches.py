"""Python workers get small Arrow batches, and tables that are read several times lie on disk."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lexispan.operators import joint_fits
from lexispan.operators.heavy_terms import top_vocabulary
from lexispan.operators.pooling import pool_words
from lexispan.plans import news
from lexispan.sources import scratch

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def limits(spark, monkeypatch):
    """The batch limit at the time each table is stored, by its name."""
    found, write = {}, scratch.stored

    def noted(df, name):
        found[name] = spark.conf.getAll.get(SETTING)
        return write(df, name)

    monkeypatch.setattr(scratch, "stored", noted)
    return found


@pytest.fixture
def folder(spark, tmp_path):
    """Documents and vectors of a few words, one text null."""
    rows = [(i, None if i == 3 else f"The cats of word{'ab'[i % 2]} see cats. A cat, boxes and a box {'dog ' * (i % 4)}") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    vectors = [(i, [float(i + k) for k in range(64)]) for i in range(5)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    return str(tmp_path)


def most_rows(spark):
    """Rows of the largest batch that a Python function gets of 2,000 rows of about 3 KB."""
    @F.arrow_udf("int")
    def rows(x: pa.Array) -> pa.Array:
        return pa.array([len(x)] * len(x), pa.int32())

    texts = spark.range(0, 2000, 1, 1).select(F.array_repeat(F.lit("abcdefgh"), 200).alias("t"))
    return texts.select(rows("t").alias("n")).agg(F.max("n")).first()[0]


def test_batches_are_small_inside_the_block_alone(spark, monkeypatch):
    monkeypatch.setattr(scratch, "BATCH_BYTES", 1 << 18)
    assert most_rows(spark) == 2000
    with scratch.small_batches(spark):
        assert most_rows(spark) < 200
    assert most_rows(spark) == 2000 and SETTING not in spark.conf.getAll
    with pytest.raises(ZeroDivisionError), scratch.small_batches(spark):
        1 / 0
    assert SETTING not in spark.conf.getAll
    for own, inside in (("64m", str(1 << 18)), ("1000", "1000")):
        spark.conf.set(SETTING, own)
        try:
            with scratch.small_batches(spark):
                assert spark.conf.get(SETTING) == inside
            assert spark.conf.get(SETTING) == own
        finally:
            spark.conf.unset(SETTING)


def test_cleaned_words_are_stored(spark, folder, limits):
    tokens = news._kept_tokens(spark, folder)
    assert limits["tokens"] == str(scratch.BATCH_BYTES)
    assert not tokens.is_cached and "ArrowEvalPython" not in tokens._jdf.queryExecution().executedPlan().toString()
    found = {r.doc_id: r.tokens for r in tokens.collect()}
    assert sorted(found) == [i for i in range(20) if i != 3]
    assert found[1] == ["cat", "wordb", "see", "cat", "cat", "box", "box", "dog"]


def test_tagged_words_are_stored(spark, folder, limits):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    news.pos_bigram_vocab(spark, folder).collect()
    assert limits.pop("tagged") == str(scratch.BATCH_BYTES)
    news.tags_in_context(spark, folder).collect()
    assert limits["tagged"] == str(scratch.BATCH_BYTES)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


@pytest.mark.parametrize("bounds", [{}, {"max_matrix_bytes": 0}, {"max_matrix_bytes": 0, "max_hot_bytes": 8}])
def test_pooling_runs_python_once_on_small_batches(spark, limits, bounds):
    df = spark.createDataFrame([(1, ["a", "b", "b"]), (2, ["c"]), (3, []), (4, None)], "k long, t array<string>")
    table = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, 8.0])], "word string, vec array<float>")
    found = pool_words(df, "k", "t", table, "mean", 2, **bounds)
    assert limits["pooled"] == str(scratch.BATCH_BYTES)
    assert "ArrowEvalPython" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.k: r.features for r in found.collect()} == {1: [3.0, 6.0], 2: [0.0, 0.0], 3: [0.0, 0.0], 4: [0.0, 0.0]}


def test_bounded_counters_get_small_batches(spark, limits):
    df = spark.createDataFrame([(["a", "b", "a"],), (["a", "c"],), (None,)], "t array<string>")
    assert [r.term for r in top_vocabulary(df, "t", 2).collect()] == ["a", "b"]
    assert limits["summaries"] == str(scratch.BATCH_BYTES)


def test_rounds_of_a_fit_get_small_batches(spark, limits, monkeypatch):
    rounds, work = [], joint_fits._round

    def noted(models):
        rounds.append(spark.conf.getAll.get(SETTING))
        return work(models)

    monkeypatch.setattr(joint_fits, "_round", noted)
    rows = spark.range(200).select((F.col("id") % 2).alias("label"), array_to_vector(F.array(
        (F.col("id") % 2 * 2 - 1).cast("double"), (F.col("id") % 7).cast("double"))).alias("features"))
    model = joint_fits.fit_jointly({"m": (rows, joint_fits.Svm(0.01))})["m"]
    assert model.gap <= 1e-4 and np.sign(model.weights[0]) == 1
    assert limits["blocks"] == str(scratch.BATCH_BYTES) and set(rounds) == {str(scratch.BATCH_BYTES)}
    assert SETTING not in spark.conf.getAll
