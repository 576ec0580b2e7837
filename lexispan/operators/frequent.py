"""The most frequent values of a list column, without a sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.operators.unnest import unnest
from lexispan.sources.scratch import stored

#: Steps of the counts per doubling.
STEPS = 8


def frequent_values(df: DataFrame, lists: str, at_most: int) -> DataFrame:
    """``(value, n)`` of the values that occur most, ``at_most`` of them or some fewer.

    Counts are cut into steps, a few hundred numbers for the driver; the values of the
    highest steps that fit together are taken.  Null lists and elements count nothing.
    """
    counted = stored(
        unnest(df, [], lists, "value").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("step", F.floor(F.log2("n") * STEPS).cast("int")), "value-counts")
    least, total = None, 0
    for row in sorted(counted.groupBy("step").agg(F.count(F.lit(1)).alias("values")).collect(), reverse=True):
        total += row["values"]
        if total > at_most:
            break
        least = row["step"]
    return counted.filter(F.lit(False) if least is None else F.col("step") >= least).select("value", "n")
