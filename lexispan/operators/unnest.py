"""One row per array element."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(
    df: DataFrame, keep: Sequence[str | Column], array: str | Column, name: str
) -> DataFrame:
    """``keep`` columns and ``name``, one row per non-null element of ``array``.

    A plain ``explode`` of a computed array column makes Spark add the filter
    ``size(array) > 0`` at the scan, and with it evaluate the array a second time
    (tokenising every text twice).  The outer form followed by a null check on the
    element does not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(
        F.col(name).isNotNull()
    )
