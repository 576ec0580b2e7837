"""Evaluator for extractive QA with unanswerable questions.

Tables: gold ``(qid, golds array<string>)``, predictions ``(qid, text)`` and,
optionally, no-answer scores ``(qid, na_prob)``.  A no-answer score may be any
number, such as a raw logit.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lexispan.functions.answers import (
    exact_score,
    f1_score,
    gold_forms,
    normalize_answer,
)
from lexispan.operators.ranking import running_totals

# Score sums are decimal, so their value does not depend on the order of addition
# and equal running sums compare equal.
SCORE_TYPE = "decimal(28,12)"


def with_has_ans(gold: DataFrame) -> DataFrame:
    """Add ``has_ans``: whether the question has any gold answer."""
    return gold.withColumn("has_ans", F.size("golds") > 0)


def raw_scores(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """``(qid, has_ans, pred, exact, f1)`` for questions with a prediction.

    A question without usable gold answer is right when the prediction is empty.
    Both scores are computed inside the joined row.
    """
    joined = with_has_ans(gold).join(
        predictions.select("qid", F.col("text").alias("pred")), "qid"
    )
    prepared = joined.select(
        "qid", "has_ans", "pred",
        gold_forms(F.col("golds")).alias("_golds"),
        normalize_answer(F.col("pred")).alias("_pred"),
    )
    return prepared.select(
        "qid", "has_ans", "pred",
        exact_score(F.col("_golds"), F.col("_pred")).alias("exact"),
        f1_score(F.col("_golds"), F.col("_pred")).alias("f1"),
    )


def missing_predictions(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Questions for which no prediction was given."""
    return gold.select("qid").join(predictions.select("qid"), "qid", "left_anti")


def restrict_to(scores: DataFrame, questions: DataFrame) -> DataFrame:
    """Scores of the listed questions only."""
    return scores.join(questions.select("qid"), "qid", "left_semi")


def with_na_prob(scores: DataFrame, na_probs: DataFrame | None) -> DataFrame:
    """Add ``na_prob``: 0 for every question when no table is given.

    With a table, a question missing from it keeps a null score.
    """
    if na_probs is None:
        return scores.withColumn("na_prob", F.lit(0.0))
    return scores.join(na_probs.select("qid", "na_prob"), "qid", "left")


def threshold_scores(scores: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Treat ``na_prob > threshold`` as an empty answer: right iff unanswerable."""
    silent = F.col("na_prob") > threshold
    right = (~F.col("has_ans")).cast("double")
    return scores.withColumns({
        name: F.when(silent, right).otherwise(F.col(name).cast("double"))
        for name in ("exact", "f1")
    })


def _long(row: DataFrame, names: list[str]) -> DataFrame:
    """One row of metrics as ``(metric, value)`` rows, nulls left out."""
    pairs = [
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
        for n in names
    ]
    return row.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())


def summary_by(scores: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """``(slice, keys.., total, exact, f1)``: the summary of any slices, in one aggregate.

    Each of ``sets`` names the columns that cut one way of slicing, none for all questions;
    keys that a row's slicing leaves out are null, and ``slice`` names those it has, joined
    by ``+``.  A null in a key column is a value like any other.
    """
    keys = list(dict.fromkeys(key for keys in sets for key in keys))
    means = [(100 * F.avg(F.col(name).cast(SCORE_TYPE)).cast("double")).alias(name) for name in ("exact", "f1")]
    cut = scores.groupingSets([[F.col(k) for k in chosen] for chosen in sets], *[F.col(k) for k in keys]).agg(
        F.array_join(F.array(*[F.when(F.grouping(k) == 0, k) for k in keys]), "+").alias("slice"),
        F.count(F.lit(1)).alias("total"), *means)
    return cut.select("slice", *keys, "total", "exact", "f1").filter("total > 0")


def summary(scores: DataFrame) -> DataFrame:
    """``(metric, value)``: mean scores times 100 and totals, in one aggregate.

    For all questions, for the answerable (HasAns) and the unanswerable (NoAns)
    ones; a slice without questions is left out.
    """
    slices = {
        "": F.lit(True), "HasAns_": F.col("has_ans"), "NoAns_": ~F.col("has_ans")
    }
    columns = []
    for prefix, member in slices.items():
        for name in ("exact", "f1"):
            score = F.col(name).cast(SCORE_TYPE)
            hits = F.sum(F.when(member, score)).cast("double")
            columns.append(
                (100 * hits / F.nullif(F.count_if(member), F.lit(0))).alias(prefix + name)
            )
        columns.append(F.nullif(F.count_if(member), F.lit(0)).alias(f"{prefix}total"))
    row = scores.agg(*columns)
    return _long(row, row.columns)


def pr_points(scores: DataFrame, answerable: int) -> DataFrame:
    """Precision and recall at each threshold, for exact, F1 and oracle scores.

    One row per distinct ``na_prob`` and one for the start (recall 0, precision 1)
    with a null ``na_prob``.  All questions count in the denominator of precision,
    only the scores of answerable ones in the numerator.  ``answerable`` is their
    number in the whole gold set.
    """
    gain = {
        "exact": F.col("exact"), "f1": F.col("f1"), "oracle": F.lit(1),
    }
    ties = scores.filter(F.col("na_prob").isNotNull()).groupBy("na_prob").agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.sum(F.when(F.col("has_ans"), c).otherwise(0).cast(SCORE_TYPE))
            .cast("decimal(38,12)").alias(f"tp_{name}")
            for name, c in gain.items()
        ],
    )
    totals = {"asked": F.col("n")} | {f"upto_{n}": F.col(f"tp_{n}") for n in gain}
    summed = running_totals(ties, ["na_prob"], totals)
    columns = ["na_prob"]
    for name in gain:
        upto = F.col(f"upto_{name}").cast("double")
        columns += [
            (upto / F.col("asked")).alias(f"precision_{name}"),
            (upto / answerable).alias(f"recall_{name}"),
            (F.col(f"tp_{name}").cast("double") / answerable).alias(f"step_{name}"),
        ]
    points = summed.select(*columns)
    first = ", ".join(
        f"1.0D AS precision_{n}, 0.0D AS recall_{n}, 0.0D AS step_{n}" for n in gain
    )
    start = scores.sparkSession.sql(f"SELECT CAST(NULL AS DOUBLE) AS na_prob, {first}")
    return start.unionByName(points)


def average_precision(points: DataFrame) -> DataFrame:
    """``(metric, value)``: area under each curve of ``pr_points``, times 100."""
    names = ["exact", "f1", "oracle"]
    row = points.agg(*[
        (100 * F.sum(F.col(f"precision_{n}") * F.col(f"step_{n}"))).alias(f"pr_{n}_ap")
        for n in names
    ])
    return _long(row, row.columns)


def best_thresholds(scores: DataFrame, unanswerable: int) -> DataFrame:
    """``(metric, value)``: best exact and F1 over all no-answer thresholds.

    Starts from answering nothing (``unanswerable`` questions of the gold set are
    right) and adds questions in (na_prob, qid) order: an answerable one gains its
    score, an unanswerable one with a non-empty prediction loses 1.  The first
    strict maximum wins; its threshold is 0 when the start is never beaten.
    """
    def gain(name):
        lost = F.when(F.col("pred") != "", -1).otherwise(0)
        return (
            F.when(F.col("na_prob").isNull(), 0)
            .when(F.col("has_ans"), F.col(name)).otherwise(lost)
            .cast(SCORE_TYPE).cast("decimal(38,12)")
        )

    summed = running_totals(
        scores, ["na_prob", "qid"], {f"gain_{n}": gain(n) for n in ("exact", "f1")}
    )
    # Of equal sums the lowest na_prob comes first, whatever its qid.
    best = summed.agg(*[
        F.max(F.struct(
            F.col(f"gain_{name}").alias("gain"), (-F.col("na_prob")).alias("order")
        )).alias(name)
        for name in ("exact", "f1")
    ], F.count(F.lit(1)).alias("_scored"))
    columns = []
    for name in ("exact", "f1"):
        beaten = F.col(f"{name}.gain") > 0
        top = F.when(beaten, F.col(f"{name}.gain")).otherwise(0).cast("double")
        columns += [
            (100 * (unanswerable + top) / F.col("_scored")).alias(f"best_{name}"),
            F.when(beaten, -F.col(f"{name}.order")).otherwise(F.lit(0.0))
            .alias(f"best_{name}_thresh"),
        ]
    row = best.filter(F.col("_scored") > 0).select(*columns)
    return _long(row, row.columns)


def na_histogram(scores: DataFrame, bins: int = 20) -> DataFrame:
    """``(has_ans, bin, share)``: equal bins on [0, 1], the last one closed.

    Shares refer to all questions of the slice, also those outside [0, 1].
    """
    x = F.col("na_prob")
    number = F.when(
        x.between(0.0, 1.0),
        F.least(F.width_bucket(x, F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins)),
    )
    counts = scores.groupBy("has_ans", number.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # At most two slices of bins + 1 rows each.
    share = F.col("n") / F.sum("n").over(Window.partitionBy("has_ans"))
    return counts.withColumn("share", share).filter(F.col("bin").isNotNull()).select(
        "has_ans", "bin", "share"
    )


def class_sizes(gold: DataFrame) -> tuple[int, int]:
    """Numbers of answerable and unanswerable questions of a gold set."""
    row = with_has_ans(gold).agg(
        F.count_if("has_ans").alias("yes"), F.count_if(~F.col("has_ans")).alias("no")
    ).first()
    return row["yes"], row["no"]


def evaluate(
    gold: DataFrame,
    predictions: DataFrame,
    na_probs: DataFrame | None = None,
    threshold: float = 1.0,
) -> DataFrame:
    """The whole evaluation record as ``(metric, value)`` rows.

    Best thresholds and average precision need ``na_probs``; the latter also
    needs an answerable question.  The scores are kept while the record is computed,
    which happens at once: it has 18 rows at most.
    """
    scores = with_na_prob(raw_scores(gold, predictions), na_probs).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        parts = [summary(threshold_scores(scores, threshold))]
        if na_probs is not None:
            answerable, unanswerable = class_sizes(gold)
            parts.append(best_thresholds(scores, unanswerable))
            if answerable:
                parts.append(average_precision(pr_points(scores, answerable)))
        record = reduce(DataFrame.unionByName, parts).collect()
    finally:
        scores.unpersist()
    return gold.sparkSession.createDataFrame(record, "metric string, value double")
