"""A training corpus from ``documents``: five stages, each an operator of ``lexispan.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexispan.llm.decontaminate import drop_contaminated
from lexispan.llm.exact_dedup import drop_copies
from lexispan.llm.mixing import mix_sources
from lexispan.llm.shared import forget, stored
from lexispan.llm.simhash import drop_near_duplicates
from lexispan.llm.toxicity import drop_toxic, fit
from lexispan.session import ship_package


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learnt lexicon does not call toxic."""
    ship_package(spark)
    return drop_toxic(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, case of A-Z aside, the document with the largest id."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked within 3 bits, three-word shingles, the smallest id."""
    ship_package(spark)
    return drop_near_duplicates(docs, shingle=3, radius=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item, edited or not."""
    ship_package(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every use of a document in the mixture, with its epoch and block."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("decontaminate", decontaminated),
    ("source_mix", mixed),
]

# Learnt scores, fingerprints in trees and alignments are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        forget(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
