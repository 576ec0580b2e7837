"""Answer normalisation and the two answer scores, inside one row."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispan.functions.arrays import bag_overlap, let

# ``\b`` and ``\s`` follow Unicode; the four control characters count as blanks too.
ARTICLES = r"(?U)\b(a|an|the)\b"
BLANKS = r"(?U)[\s\x1c-\x1f]+"


def normalize_answer(text: Column) -> Column:
    """Lower-case, delete ASCII punctuation, drop articles, squeeze blanks."""
    plain = F.translate(F.lower(text), string.punctuation, "")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, ARTICLES, " "), BLANKS, " "))


def split_normalized(normalized: Column) -> Column:
    return F.when(normalized == "", F.array().cast("array<string>")).otherwise(
        F.split(normalized, " ")
    )


def answer_tokens(text: Column) -> Column:
    """Tokens of the normalised answer; none for an empty one."""
    return split_normalized(normalize_answer(text))


def gold_forms(golds: Column) -> Column:
    """Normalised gold answers, empty ones dropped; ``[""]`` when none is left."""
    kept = F.filter(
        F.array_distinct(F.transform(golds, normalize_answer)), lambda g: g != ""
    )
    return let(kept, lambda k: F.when(F.size(k) > 0, k).otherwise(F.array(F.lit(""))))


def exact_score(forms: Column, prediction: Column) -> Column:
    """1 when the normalised prediction equals one of the gold forms, else 0."""
    return F.array_contains(forms, prediction).cast("int")


def _pair_f1(gold: Column, prediction: Column) -> Column:
    n_gold, n_pred = F.size(gold), F.size(prediction)

    def f1(same: Column) -> Column:
        precision, recall = same / n_pred, same / n_gold
        return F.when(same == 0, F.lit(0.0)).otherwise(
            2 * precision * recall / (precision + recall)
        )

    return F.when(
        (n_gold == 0) | (n_pred == 0), (n_gold == n_pred).cast("double")
    ).otherwise(let(bag_overlap(gold, prediction), f1))


def f1_score(forms: Column, prediction: Column) -> Column:
    """Best token F1 of the normalised prediction over the gold forms."""
    return let(
        split_normalized(prediction),
        lambda p: F.array_max(
            F.transform(
                forms, lambda g: let(split_normalized(g), lambda t: _pair_f1(t, p))
            )
        ),
    )
