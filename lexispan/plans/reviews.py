"""Queries over the reviews: labels, sampling, splits, model comparison, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.functions.text import content_words
from lexispan.operators import metrics, models, sampling
from lexispan.plans import inputs, sql
from lexispan.session import keep

FRACTION = 0.2
TRAIN_FRACTION = 0.7


def label_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = inputs.sentiment(spark, sf_dir)
    return labelled.select(
        "doc_id", F.col("Score").alias("score"), "label",
        metrics.to_signs(F.col("label")).alias("sign"),
    )


def _document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.documents(spark, sf_dir, "doc_id", "lang")


def sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly a fifth of the labelled reviews."""
    labelled = inputs.sentiment(spark, sf_dir).select("doc_id", "label")
    return sampling.sample_fraction(labelled, "doc_id", FRACTION, inputs.SEED)


def sample_fraction_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_by_hash(
        _document_ids(spark, sf_dir), "doc_id", FRACTION, inputs.SEED
    )


def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.shuffle_positions(_document_ids(spark, sf_dir), "doc_id", 44)


def head_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.head_fraction(_document_ids(spark, sf_dir), "doc_id", 4)


def interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    sourced = inputs.documents(spark, sf_dir, "doc_id").withColumn(
        "label", inputs.news_label()
    )
    return sampling.interleave(sourced, "label", "doc_id")


def _balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, label)`` of the balanced reviews.

    Counts, bounds and splits read this narrow table; texts are joined afterwards.
    """
    labelled = keep(inputs.sentiment(spark, sf_dir).select("doc_id", "label"))
    return keep(sampling.balance_classes(labelled, "doc_id", "label", inputs.SEED))


def _with_text(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    return rows.join(inputs.documents(spark, sf_dir, "doc_id", "text"), "doc_id")


def balance_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_text(spark, sf_dir, _balanced(spark, sf_dir)).select(
        "doc_id", "label", "text"
    )


def split_70_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _document_ids(spark, sf_dir)
    rows = sampling.train_rows_70_30(ids.count())
    return sampling.split_exact(ids, "doc_id", rows, inputs.SEED)


def split_70_30_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_by_hash(
        _document_ids(spark, sf_dir), "doc_id", TRAIN_FRACTION, inputs.SEED
    )


def _split_80_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    balanced = _balanced(spark, sf_dir)
    rows = sampling.train_rows_80_20(balanced.count())
    return sampling.split_exact(balanced, "doc_id", rows, inputs.SEED)


def split_80_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_80_20(spark, sf_dir).select("doc_id", "label", "split")


def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = metrics.label_distribution(inputs.sentiment(spark, sf_dir), "label")
    return shares.select("label", "n", F.round("share", 6).alias("share"))


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.split_sizes(_split_80_20(spark, sf_dir))


def _rounded(report: DataFrame, *keys: str) -> DataFrame:
    scores = ["accuracy", "precision", "recall", "f1"]
    return report.select(*keys, "n", "tp", "fp", "fn", *[F.round(s, 6).alias(s) for s in scores])


def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.binary_report(inputs.predictions(spark, sf_dir), "y", "pred"))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(inputs.predictions(spark, sf_dir), "y", "pred")


def confusion_matrix_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three classes, one of which is never predicted: its rows have no prediction."""
    rows = inputs.predictions(spark, sf_dir)
    lost = F.col("doc_id") % 4 == 0
    marked = rows.select(
        F.when(lost, 2).otherwise(F.col("y")).alias("y"), F.when(~lost, F.col("pred")).alias("pred")
    )
    return metrics.confusion_matrix(marked, "y", "pred")


def sampled_balanced_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the reviews, balanced, split 80 : 20: sizes and shares of the labels."""
    labelled = inputs.sentiment(spark, sf_dir).select("doc_id", "label")
    sample = keep(sampling.sample_fraction(labelled, "doc_id", FRACTION, inputs.SEED))
    balanced = keep(sampling.balance_classes(sample, "doc_id", "label", inputs.SEED))
    rows = sampling.train_rows_80_20(balanced.count())
    split = sampling.split_exact(balanced, "doc_id", rows, inputs.SEED)
    return split.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


def metrics_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.binary_report(
        inputs.model_predictions(spark, sf_dir), "y", "pred", ["model"]
    )
    return _rounded(report, "model")


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six feature sets on the balanced reviews, split 80 : 20, in one report."""
    split = _with_text(spark, sf_dir, _split_80_20(spark, sf_dir))
    tokens = split.select(
        "doc_id", "label", "split", content_words(F.col("text")).alias("tokens")
    )
    cleaned = keep(inputs.with_lemmas(tokens))
    train = cleaned.filter("split = 'train'").drop("split")
    test = cleaned.filter("split = 'test'").drop("split")
    embedding = keep(inputs.embedding_table(spark, sf_dir, train))
    predicted = models.compare_models(train, test, embedding, "doc_id", "tokens")
    return _rounded(metrics.binary_report(predicted, "y", "pred", ["model"]), "model")


QUERIES = {f.__name__: f for f in [
    label_reviews, sample_fraction, sample_fraction_hash, seeded_shuffle, head_fraction,
    interleave, balance_classes, split_70_30, split_70_30_hash, split_80_20,
    label_distribution, split_sizes, confusion_matrix_nulls, sampled_balanced_distribution, binary_metrics, confusion_matrix, metrics_by_model,
    model_comparison,
]}

_SPLIT = f"""WITH {sql.REVIEWS},
split AS (
  SELECT doc_id, label,
         CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id)
                   <= (SELECT count(*) - ceil(count(*) * 2 / 10) FROM balanced)
              THEN 'train' ELSE 'test' END AS split
  FROM balanced)"""


def _scores_sql(source: str, group: str = "") -> str:
    lead = f"{group}, " if group else ""
    return f"""
SELECT {lead}n, tp, fp, fn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1
FROM ({sql.binary_report(source, group)})"""


ORACLES = {
    "label_reviews": f"""WITH {sql.REVIEWS}
SELECT doc_id, score, label, CASE WHEN label = 1 THEN 1 ELSE -1 END AS sign FROM sentiment""",
    "sample_fraction": f"""WITH {sql.REVIEWS}
SELECT doc_id, label FROM (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r FROM sentiment)
WHERE r <= (SELECT round_even(count(*) * 0.2, 0) FROM sentiment)""",
    "sample_fraction_hash": """
SELECT doc_id, lang FROM documents WHERE left(md5('42:' || doc_id), 8) < '33333333'""",
    "seeded_shuffle": """
SELECT doc_id, lang, row_number() OVER (ORDER BY md5('44:' || doc_id), doc_id) AS position
FROM documents""",
    "head_fraction": """
SELECT doc_id, lang FROM (
  SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS r FROM documents)
WHERE r <= (SELECT count(*) // 4 FROM documents)""",
    "interleave": """
SELECT doc_id, label, (row_number() OVER (PARTITION BY label ORDER BY doc_id) - 1) // 2 AS pair
FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN -1 ELSE 1 END AS label FROM documents)""",
    "balance_classes": f"WITH {sql.REVIEWS}\nSELECT doc_id, label, text FROM balanced",
    "split_70_30": """
SELECT doc_id, lang, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id)
                           <= (SELECT CAST(trunc(CAST(0.7 AS DOUBLE) * count(*)) AS BIGINT) FROM documents)
                    THEN 'train' ELSE 'test' END AS split
FROM documents""",
    "split_70_30_hash": """
SELECT doc_id, lang,
       CASE WHEN left(md5('42:' || doc_id), 8) < 'b3333333' THEN 'train' ELSE 'test' END AS split
FROM documents""",
    "split_80_20": f"{_SPLIT}\nSELECT doc_id, label, split FROM split",
    "label_distribution": f"""WITH {sql.REVIEWS}
SELECT label, count(*) AS n, round(count(*) / (SELECT count(*) FROM sentiment), 6) AS share
FROM sentiment GROUP BY label""",
    "split_sizes": f"{_SPLIT}\nSELECT split, count(*) AS n FROM split GROUP BY split",
    "binary_metrics": f"WITH {sql.PREDICTIONS} {_scores_sql('predictions')}",
    "confusion_matrix": f"""WITH {sql.PREDICTIONS},
classes AS (SELECT y AS c FROM predictions UNION SELECT pred FROM predictions)
SELECT a.c AS y, b.c AS pred, (
  SELECT count(*) FROM predictions p WHERE p.y = a.c AND p.pred = b.c) AS n
FROM classes a CROSS JOIN classes b""",
    "confusion_matrix_nulls": f"""WITH {sql.PREDICTIONS},
marked AS (
  SELECT CASE WHEN doc_id % 4 = 0 THEN 2 ELSE y END AS y,
         CASE WHEN doc_id % 4 <> 0 THEN pred END AS pred FROM predictions),
classes AS (
  SELECT y AS c FROM marked UNION SELECT pred FROM marked WHERE pred IS NOT NULL)
SELECT a.c AS y, b.c AS pred, (
  SELECT count(*) FROM marked p WHERE p.y = a.c AND p.pred = b.c) AS n
FROM classes a CROSS JOIN classes b""",
    "sampled_balanced_distribution": f"""WITH {sql.REVIEWS},
sampled AS (
  SELECT doc_id, label FROM (
    SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r FROM sentiment)
  WHERE r <= (SELECT round_even(count(*) * 0.2, 0) FROM sentiment)),
even AS (
  SELECT doc_id, label FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id), doc_id) AS r
    FROM sampled)
  WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM sampled GROUP BY label))),
parts AS (
  SELECT label, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id)
                          <= (SELECT count(*) - ceil(count(*) * 2 / 10) FROM even)
                     THEN 'train' ELSE 'test' END AS split
  FROM even)
SELECT split, label, count(*) AS n FROM parts GROUP BY ALL""",
    "metrics_by_model": f"WITH {sql.MODEL_PREDICTIONS} {_scores_sql('by_model', 'model')}",
}
