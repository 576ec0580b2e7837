"""Joins with small tables: broadcast only what has been counted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000


def fetched(df: DataFrame) -> DataFrame:
    """The rows of a small table, held by the driver.

    They travel as Arrow, which Spark reads itself; a list of Python rows would start a Python
    worker per core, beside those of the query, that stays until the session ends.
    """
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Fetch at most ``max_rows`` + 1 rows; broadcast them if they were all.

    A larger table comes back as it was, without a hint, so that Spark joins it
    by shuffle.  Meant for small aggregates whose size depends on the data, such
    as one row per class.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def hint_if_bounded(df: DataFrame, row_bound: int) -> DataFrame:
    """Broadcast a table whose row count cannot exceed ``row_bound`` if that is small."""
    return F.broadcast(df) if row_bound <= MAX_BROADCAST_ROWS else df


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on ``on`` in which null equals null; key columns stay once."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(renamed, same).drop(*[f"_right_{c}" for c in on])
