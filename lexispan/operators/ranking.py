"""Ranks, running totals and k-th rows in a global order, without a one-task window.

A window with no partition key (or with one hot key) moves the whole order into
one task.  Here rows first get a bucket that follows the order; the totals per
bucket are a tiny table; and the window runs inside (group, bucket).  Buckets are
computed from literals, so a recomputed task assigns the same ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

from lexispan.operators.bounded import broadcast_if_small, null_safe_join

MAX_BUCKETS = 16_384
ROWS_PER_BUCKET = 1_000_000
SAMPLED_ROWS_PER_BUCKET = 50


def bucket_count(df: DataFrame, rows: int) -> int:
    """Buckets of about a million rows, as many as there are shuffle partitions at least."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(max(partitions, rows // ROWS_PER_BUCKET), MAX_BUCKETS))


def range_bounds(df: DataFrame, order: Sequence[str]) -> list[tuple]:
    """Boundaries that cut the rows into about equal ranges of ``order``.

    They only balance the work, never the result, so picked rows are enough: a
    hash chooses about ``SAMPLED_ROWS_PER_BUCKET`` distinct keys per bucket, and
    these reach the driver.
    """
    keys = df.select(*order)
    total = keys.count()
    buckets = bucket_count(df, total)
    if buckets < 2:
        return []
    wanted = buckets * SAMPLED_ROWS_PER_BUCKET
    if total > wanted:
        step = total // wanted
        keys = keys.filter(F.pmod(F.xxhash64(*order), F.lit(step)) == 0)
    picked = keys.distinct().orderBy(*order).collect()
    cuts = [picked[i * len(picked) // buckets] for i in range(1, buckets)] if picked else []
    return list(dict.fromkeys(tuple(row) for row in cuts))


def range_bucket(
    order: Sequence[str], types: Sequence[DataType], bounds: list[tuple]
) -> Column:
    """Number of boundaries at or below the row's key, by binary search."""
    if not bounds:
        return F.lit(0)
    columns = [
        F.lit(list(values)).cast(ArrayType(t)) for values, t in zip(zip(*bounds), types)
    ]
    key = F.struct(*order)
    steps = [2**p for p in reversed(range(len(bounds).bit_length()))]

    def probe(found: Column, step: Column) -> Column:
        at = found + step
        bound = F.struct(*[F.get(c, at - 1).alias(o) for c, o in zip(columns, order)])
        return F.when((at <= len(bounds)) & (bound <= key), at).otherwise(found)

    return F.aggregate(F.lit(steps), F.lit(0), probe)


def order_bucket(df: DataFrame, order: Sequence[str]) -> Column:
    """A bucket column for ``order``, with boundaries taken from ``df``."""
    types = [df.schema[name].dataType for name in order]
    return range_bucket(order, types, range_bounds(df, order))


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    totals: Mapping[str, Column],
    group: Sequence[str] = (),
    bucket: Column | None = None,
) -> DataFrame:
    """Add inclusive running sums in ``order`` (per ``group``), one per ``totals``.

    ``order`` must be unique per row within a group.  ``bucket`` may give another
    column that never decreases along the order.
    """
    group = list(group)
    if bucket is None:
        bucket = order_bucket(df, order)
    parts = df.select("*", bucket.alias("_bucket"), *[
        column.alias(f"_value_{name}") for name, column in totals.items()
    ])
    per_bucket = parts.groupBy(*group, "_bucket").agg(*[
        F.sum(f"_value_{name}").alias(f"_sum_{name}") for name in totals
    ])
    before = (
        Window.partitionBy(*group).orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_bucket.select(*group, "_bucket", *[
        F.sum(f"_sum_{name}").over(before).alias(f"_before_{name}") for name in totals
    ])
    upto = (
        Window.partitionBy(*group, "_bucket").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Few rows: buckets times groups.  They are counted before broadcasting.
    joined = null_safe_join(parts, broadcast_if_small(offsets), [*group, "_bucket"])
    return joined.select(*df.columns, *[
        (F.sum(f"_value_{name}").over(upto)
         + F.coalesce(F.col(f"_before_{name}"), F.lit(0))).alias(name)
        for name in totals
    ])


def ranked(
    df: DataFrame,
    order: Sequence[str],
    name: str = "rank",
    group: Sequence[str] = (),
    bucket: Column | None = None,
) -> DataFrame:
    """Add the 1-based position in ``order`` within each ``group``."""
    return running_totals(df, order, {name: F.lit(1).cast("bigint")}, group, bucket)


def _bucket_sizes(keys: DataFrame, group: list[str]) -> DataFrame:
    """Rows per (group, bucket) and, per group, the rows up to its end and in all."""
    upto = (
        Window.partitionBy(*group).orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sizes = keys.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    return broadcast_if_small(sizes.select(
        "*",
        F.sum("_rows").over(upto).alias("_upto"),
        F.sum("_rows").over(Window.partitionBy(*group)).alias("_size"),
    ))


def _last_keys(
    keys: DataFrame, sizes: DataFrame, order: Sequence[str], group: list[str]
) -> DataFrame:
    """Per group, the key of its k-th row; ``sizes`` carries ``k``.

    Only the rows of the one bucket in which the k-th row lies are ranked.
    """
    edge = sizes.filter(
        (F.col("_upto") - F.col("_rows") < F.col("k")) & (F.col("k") <= F.col("_upto"))
    ).select(*group, "_bucket", (F.col("k") - F.col("_upto") + F.col("_rows")).alias("_need"))
    at_edge = null_safe_join(keys, broadcast_if_small(edge), [*group, "_bucket"])
    position = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(*order))
    return (
        at_edge.withColumn("_position", position)
        .filter(F.col("_position") == F.col("_need"))
        .select(*group, F.struct(*order).alias("_last"))
    )


def kth_key(
    df: DataFrame, order: Sequence[str], k: int, bucket: Column | None = None
) -> tuple | None:
    """The ``order`` values of the k-th row, or None when there are fewer rows."""
    keys = df.select(*order)
    keys = keys.withColumn("_bucket", order_bucket(keys, order) if bucket is None else bucket)
    sizes = _bucket_sizes(keys, []).withColumn("k", F.lit(k))
    found = _last_keys(keys, sizes, order, []).collect()
    return tuple(found[0]["_last"]) if found else None


def up_to(order: Sequence[str], last: tuple) -> Column:
    """Rows at or before the key ``last``; the first column can reach the scan."""
    bound = F.struct(*[F.lit(v).alias(o) for v, o in zip(last, order)])
    return (F.col(order[0]) <= F.lit(last[0])) & (F.struct(*order) <= bound)


def first_rows(
    df: DataFrame, order: Sequence[str], k: int, bucket: Column | None = None
) -> DataFrame:
    """Exactly the first ``k`` rows in ``order``, found without sorting the table.

    The rows are taken by comparing with the k-th key, so they are not shuffled.
    """
    if k <= 0:
        return df.limit(0)
    last = kth_key(df, order, k, bucket)
    return df if last is None else df.filter(up_to(order, last))


def first_rows_per_group(
    df: DataFrame,
    order: Sequence[str],
    k: int,
    group: Sequence[str],
    bucket: Column | None = None,
) -> DataFrame:
    """The first ``k`` rows of every group in ``order``; smaller groups stay whole."""
    group = list(group)
    keys = df.select(*group, *order)
    keys = keys.withColumn("_bucket", order_bucket(keys, order) if bucket is None else bucket)
    sizes = _bucket_sizes(keys, group).withColumn("k", F.lit(k))
    last = _last_keys(keys, sizes, order, group)
    whole = sizes.filter("_size < k").select(
        *group, F.lit(None).cast(last.schema["_last"].dataType).alias("_last")
    ).distinct()
    rule = broadcast_if_small(last.unionByName(whole))
    return null_safe_join(df, rule, group).filter(
        F.col("_last").isNull() | (F.struct(*order) <= F.col("_last"))
    ).select(*df.columns)


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of every group, each row with its 1-based ``rank``.

    Spark cuts each task's part of a group to its first ``n`` rows before the
    shuffle, so a hot group arrives as ``n`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)
