"""Queries that write the given data as the files other programs use, and read these back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.operators.models import map_batches
from lexispan.plans import inputs, qa, sql
from lexispan.sources import corpora
from lexispan.sources import qa as qa_files
from lexispan.sources.scratch import new_path


def csv_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two news corpora as CSV with line breaks in the texts, read back with their labels."""
    docs = inputs.documents(spark, sf_dir, "doc_id", "text", "lang", "source").withColumn("label", inputs.news_label())
    paths = {}
    for label in (-1, 1):
        path = new_path(spark, "news-csv")
        corpora.write_csv(docs.filter(F.col("label") == label).select(
            F.col("doc_id").cast("string").alias("title"), "text", F.col("lang").alias("subject"),
            F.col("source").alias("date")), path)
        paths[path] = label
    return corpora.labelled_csv(spark, paths).select(
        F.col("title").cast("bigint").alias("doc_id"), "label", F.col("subject").alias("lang"),
        F.char_length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def csv_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as CSV, read back and labelled."""
    path = new_path(spark, "reviews-csv")
    reviews = inputs.reviews(spark, sf_dir)
    unused = ("ProductId", "UserId", "ProfileName", "HelpfulnessNumerator", "HelpfulnessDenominator")
    corpora.write_csv(reviews.select(
        "doc_id", *[F.lit(None).cast("string").alias(c) for c in unused], "Score",
        F.lit(None).cast("long").alias("Time"), F.lit("a, \"b\"").alias("Summary"), "Text"), path)
    return corpora.labelled_reviews(corpora.reviews_csv(spark, path)).select(
        F.col("Id").alias("doc_id"), F.col("Score").alias("score"), "label", F.md5("Text").alias("text_md5"))


def qa_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples as one nested JSON document, read back by ranges and flattened."""
    path = new_path(spark, "qa-document")
    qa_files.write_document(inputs.qa_examples(spark, sf_dir), path, single_file=False)
    return qa.flat_rows(qa_files.flatten_articles(qa_files.read_document(spark, path, one_document=True)))


def prediction_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions and no-answer scores as one JSON object each, read back by ranges."""
    texts, probs = new_path(spark, "predictions"), new_path(spark, "na-probs")
    qa_files.write_prediction_map(inputs.qa_predictions(spark, sf_dir), texts, single_file=False)
    qa_files.write_prediction_map(inputs.qa_na_probs(spark, sf_dir), probs, value="na_prob", single_file=False)
    return qa_files.read_na_prob_map(spark, probs, one_document=True).join(
        qa_files.read_prediction_map(spark, texts, one_document=True), "qid", "left").select(
        F.col("qid").cast("bigint").alias("qid"), "text", F.round("na_prob", 6).alias("na_prob"))


def qa_examples_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat examples written one JSON object per line, read back, the answerable ones."""
    path = new_path(spark, "examples")
    inputs.qa_examples(spark, sf_dir).write.json(path)
    return qa_files.answerable(qa_files.read_examples(spark, path)).select(
        "id", F.get("answers.text", F.lit(0)).alias("answer"))


def metrics_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation written as a metrics file and read back."""
    path = new_path(spark, "metrics")
    qa_files.write_metrics(qa.qa_eval_summary(spark, sf_dir), path)
    return spark.read.schema("metric string, value double").json(path)


def mapped_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function on batches with an argument, which drops a column and gives a row per thousand characters."""
    def cut(batch, size):
        lengths = batch["text"].fillna("").str.len()
        parts = batch.assign(n_chars=lengths, part=[list(range(max(1, -(-n // size)))) for n in lengths])
        return parts.explode("part")[["doc_id", "part", "n_chars"]].astype("int64")

    docs = inputs.documents(spark, sf_dir, "doc_id", "text", "source")
    return map_batches(docs, cut, "doc_id bigint, part bigint, n_chars bigint", drop=["source"], size=1000)


QUERIES = {f.__name__: f for f in [
    csv_news, csv_reviews, qa_document, prediction_map, qa_examples_file, metrics_file, mapped_batches,
]}

ORACLES = {
    "csv_news": """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN -1 ELSE 1 END AS label, lang,
       CAST(length(nullif(text, '')) AS INTEGER) AS n_chars, md5(nullif(text, '')) AS text_md5 FROM documents""",
    "csv_reviews": f"""WITH {sql.REVIEWS}
SELECT doc_id, score, label, md5(text) AS text_md5 FROM sentiment WHERE text <> ''""",
    "qa_examples_file": qa.ORACLES["qa_answerable"],
    "metrics_file": qa.ORACLES["qa_eval_summary"],
    "mapped_batches": """WITH d AS (SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM documents)
SELECT doc_id, unnest(range(greatest(1, (n_chars + 999) // 1000))) AS part, n_chars FROM d""",
    "qa_document": qa.ORACLES["qa_flatten"],
    "prediction_map": f"""WITH {sql.QA}
SELECT n.qid, p.pred AS text, round(n.na_prob, 6) AS na_prob FROM na n LEFT JOIN preds p ON n.qid = p.qid""",
}
