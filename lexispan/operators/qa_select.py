"""Choosing an answer text from the start and end scores of each window.

Input rows: ``(example_id, window_idx, context, offsets array<struct<s, e>>,
start_logits array<double>, end_logits array<double>)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.functions.arrays import argmax
from lexispan.functions.text import char_slice


def spans(windows: DataFrame) -> DataFrame:
    """``(example_id, window_idx, text, score, na_score)`` of each window.

    Both ends are the first maximum of their scores, put in order; the score is
    read at the ordered ends, and ``na_score`` at position 0.
    """
    ends = windows.select(
        "*", argmax(F.col("start_logits")).alias("_a"), argmax(F.col("end_logits")).alias("_b")
    ).withColumns({"_from": F.least("_a", "_b"), "_to": F.greatest("_a", "_b")})
    first, last = F.get("offsets", F.col("_from")), F.get("offsets", F.col("_to"))
    return ends.select(
        "example_id", "window_idx",
        char_slice(F.col("context"), first["s"], last["e"]).alias("text"),
        (F.get("start_logits", F.col("_from")) + F.get("end_logits", F.col("_to")))
        .alias("score"),
        (F.get("start_logits", F.lit(0)) + F.get("end_logits", F.lit(0))).alias("na_score"),
    )


def best_window(windows: DataFrame) -> DataFrame:
    """``(example_id, text, score)`` of the highest-scoring window, the first of equals.

    An aggregate rather than a sorted window, so it is combined before the shuffle.
    """
    best = F.max_by(
        F.struct("text", "score"),
        F.struct(F.col("score"), (-F.col("window_idx")).alias("order")),
    )
    return spans(windows).groupBy("example_id").agg(best.alias("best")).select(
        "example_id", "best.*"
    )


def last_window(windows: DataFrame, threshold: float = 0.0) -> DataFrame:
    """``(example_id, text, na_prob)`` of the last window of each example.

    The text is empty when the no-answer score exceeds the span score by more than
    ``threshold``.
    """
    silent = F.col("na_score") > F.col("score") + threshold
    decided = spans(windows).withColumn("text", F.when(silent, "").otherwise(F.col("text")))
    last = F.max_by(F.struct("text", F.col("na_score").alias("na_prob")), "window_idx")
    return decided.groupBy("example_id").agg(last.alias("last")).select(
        "example_id", "last.*"
    )


def no_answer_decisions(windows: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Per window: the span text, both scores and the text after the decision."""
    silent = F.col("na_score") > F.col("score") + threshold
    return spans(windows).withColumn("answer", F.when(silent, "").otherwise(F.col("text")))
