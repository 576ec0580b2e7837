"""News corpora and reviews from CSV files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.sources.ranges import CsvRecords, records

# Quoted fields may hold line breaks and doubled quotes.
CSV_OPTIONS = {"multiLine": True, "escape": '"', "mode": "PERMISSIVE"}
NEWS_SCHEMA = "title string, text string, subject string, date string"
REVIEW_SCHEMA = (
    "Id bigint, ProductId string, UserId string, ProfileName string, "
    "HelpfulnessNumerator int, HelpfulnessDenominator int, Score int, "
    "Time bigint, Summary string, Text string"
)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV files whose fields may hold line breaks, each read by as many tasks as it has byte ranges.

    The first line of a file is its header and names nothing: columns follow ``schema``
    by position.  A field with a quote, separator or line break must be quoted and its
    quotes doubled, as CSV writers do.  An empty field, quoted or not, is null;
    rows that are short or don't fit the schema have nulls.
    """
    lines = records(spark, [path], CsvRecords()).filter("NOT (start = 0 AND seq = 0)")
    fields = F.from_csv(F.regexp_replace("record", r"\r$", ""), schema, CSV_OPTIONS)
    return lines.select(fields.alias("fields")).select("fields.*")


def write_csv(df: DataFrame, path: str) -> None:
    """Write a folder of CSV files with headers that ``read_csv`` reads back; empty texts come back null."""
    df.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def labelled_csv(
    spark: SparkSession, paths: Mapping[str, int], schema: str = NEWS_SCHEMA
) -> DataFrame:
    """One table from several CSV sources, each with its ``label`` and ``source``."""
    sources = [
        read_csv(spark, path, schema).withColumn("label", F.lit(label)).withColumn("source", F.lit(path))
        for path, label in paths.items()
    ]
    return reduce(DataFrame.unionByName, sources)


def reviews_csv(spark: SparkSession, path: str, schema: str = REVIEW_SCHEMA) -> DataFrame:
    return read_csv(spark, path, schema)


def score_label(score: Column) -> Column:
    """1 for scores above 3, else 0."""
    return F.when(score > 3, 1).otherwise(0)


def labelled_reviews(df: DataFrame, score: str = "Score", text: str = "Text") -> DataFrame:
    """Reviews with text and score, the neutral score 3 left out, with ``label``."""
    # Comparing drops a null score; plain null checks reach the scan, ``na.drop`` does not.
    return df.filter(F.col(text).isNotNull() & (F.col(score) != 3)).withColumn(
        "label", score_label(F.col(score))
    )
