"""Bucketed tables and counts of a growing folder."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexispan.operators import qa_eval
from lexispan.sources.tables import bucketed
from lexispan.streaming.word_counts import count_new_files, current_counts


def test_bucketed_tables_are_joined_without_a_shuffle(spark, tmp_path):
    ids = spark.range(500)
    made = {
        "gold": ids.select(F.col("id").alias("qid"), F.array(F.col("id").cast("string")).alias("golds")),
        "preds": ids.select(F.col("id").alias("qid"), (F.col("id") - F.col("id") % 2).cast("string").alias("text")),
        "probs": ids.select(F.col("id").alias("qid"), F.lit(0.5).alias("na_prob")),
    }
    gold, preds, probs = (bucketed(df, f"t_{name}", "qid", 8, str(tmp_path / name)) for name, df in made.items())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = qa_eval.with_na_prob(qa_eval.raw_scores(gold, preds), probs)
        per_question = scores.groupBy("qid").agg(F.max("exact").alias("exact"))
        plan = per_question._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        missing = qa_eval.missing_predictions(gold, preds.filter("qid <> 7"))
        assert "Exchange" not in missing._jdf.queryExecution().executedPlan().toString()
        assert [r.qid for r in missing.collect()] == [7]
        assert per_question.agg(F.sum("exact")).first()[0] == 250
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    again = bucketed(made["gold"].limit(3), "t_gold", "qid", 8, str(tmp_path / "gold"))
    assert again.count() == 3


def split_words(df):
    return df.select("label", F.split("text", " ").alias("tokens"))


def test_counts_go_on_after_a_restart(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    with pytest.raises(FileNotFoundError):
        current_counts(spark, state)
    want = Counter()
    deliveries = [[(1, "a b a"), (-1, "b")], [(1, "a c"), (None, "x"), (1, None)], [(-1, "b b")]]
    for number, rows in enumerate(deliveries):
        spark.createDataFrame(rows, "label int, text string").repartition(2).write.mode("append").parquet(source)
        count_new_files(spark, source, "label int, text string", state, split_words, files_per_batch=1)
        want.update((label, w) for label, text in rows for w in (text or "").split())
        got = {(r.label, r.term): r.cnt for r in current_counts(spark, state).collect()}
        assert got == want, number
    count_new_files(spark, source, "label int, text string", state, split_words)
    assert {(r.label, r.term): r.cnt for r in current_counts(spark, state).collect()} == want
    batches = [p.name for p in (tmp_path / "state" / "counts").iterdir()]
    assert len(batches) >= 4
    assert "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage" not in spark.conf.getAll
