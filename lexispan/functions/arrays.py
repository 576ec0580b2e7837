"""Array expressions shared by the text, window and scoring functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    A column used inside a lambda is evaluated again for every element unless it
    is a plain attribute or a lambda variable; binding it here avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_starts(ordered: Column) -> Column:
    """0-based positions at which a new value begins in a sorted array."""
    marked = F.transform(
        ordered,
        lambda x, i: F.when((i == 0) | (F.get(ordered, i - 1) != x), i),
    )
    return F.filter(marked, lambda i: i.isNotNull())


def value_counts(values: Column) -> Column:
    """``array<struct<value, n>>``: distinct values of an array with their counts.

    Sorts the array and measures its runs: n log n, inside the row, no shuffle.
    """

    def counted(s: Column) -> Column:
        return let(
            run_starts(s),
            lambda st: F.transform(
                st,
                lambda a, k: F.struct(
                    F.get(s, a).alias("value"),
                    (F.coalesce(F.get(st, k + 1), F.size(s)) - a).alias("n"),
                ),
            ),
        )

    # Sorted by the built-in order; ``array_sort`` calls a function for each comparison.  Nulls come last.
    return let(values, lambda v: let(
        F.concat(F.sort_array(F.array_compact(v)), F.filter(v, lambda x: x.isNull())), counted))


def occurrence_tags(values: Column) -> Column:
    """Rename the k-th occurrence of ``x`` to ``"k x"``, so that bags become sets."""
    return F.flatten(
        F.transform(
            value_counts(values),
            lambda run: F.transform(
                F.sequence(F.lit(1), run["n"]),
                lambda k: F.concat_ws(" ", k.cast("string"), run["value"]),
            ),
        )
    )


def bag_overlap(left: Column, right: Column) -> Column:
    """Size of the multiset intersection: sum over values of min(count, count)."""
    return F.size(F.array_intersect(occurrence_tags(left), occurrence_tags(right)))


def argmax(values: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def pad_or_cut(values: Column, length: int, pad: Column) -> Column:
    """Bring an array to a fixed length: cut the tail or append ``pad``."""
    return F.slice(F.concat(values, F.array_repeat(pad, length)), 1, length)


def attention_mask(values: Column, length: int) -> Column:
    """1 where ``pad_or_cut`` keeps a value of the array, 0 where it pads."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(length)),
        lambda i: (i <= F.size(values)).cast("int"),
    )
