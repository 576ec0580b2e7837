"""Repeatable shuffling, sampling, balancing and splitting.

Every draw is the order of ``md5(seed:id)``, so it depends on the row alone: not
on partitioning, retries or the number of executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.operators.ranking import (
    first_rows,
    first_rows_per_group,
    kth_key,
    ranked,
    up_to,
)

DRAW = "_draw"
PREFIX_DIGITS = 4


def draw_key(seed: int | str, id_column: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))


def draw_bucket() -> Column:
    """65,536 equal ranges of the draw: its first hex digits as a number."""
    return F.conv(F.substring(DRAW, 1, PREFIX_DIGITS), 16, 10).cast("int")


def fraction_threshold(fraction: float) -> str:
    """The draw below which a share of ``fraction`` of all rows lies (8 digits)."""
    if not 0 <= fraction < 1:
        raise ValueError("fraction must be in [0, 1)")
    return f"{int(fraction * 16**8):08x}"


def shuffled(df: DataFrame, id_column: str, seed: int | str) -> DataFrame:
    """All rows in a seeded random order (a range-partitioned sort)."""
    return (
        df.withColumn(DRAW, draw_key(seed, id_column)).orderBy(DRAW, id_column).drop(DRAW)
    )


def shuffle_positions(df: DataFrame, id_column: str, seed: int | str) -> DataFrame:
    """All rows with their 1-based ``position`` in the seeded order."""
    drawn = df.withColumn(DRAW, draw_key(seed, id_column))
    return ranked(drawn, [DRAW, id_column], "position", bucket=draw_bucket()).drop(DRAW)


def sample_by_hash(
    df: DataFrame, id_column: str, fraction: float, seed: int | str
) -> DataFrame:
    """About ``fraction`` of the rows: a filter on the row, with no shuffle."""
    eight = F.substring(draw_key(seed, id_column), 1, 8)
    return df.filter(eight < fraction_threshold(fraction))


def sample_rows(df: DataFrame, id_column: str, rows: int, seed: int | str) -> DataFrame:
    """Exactly ``rows`` rows, drawn without replacement."""
    drawn = df.withColumn(DRAW, draw_key(seed, id_column))
    return first_rows(drawn, [DRAW, id_column], rows, bucket=draw_bucket()).drop(DRAW)


def sample_fraction(
    df: DataFrame, id_column: str, fraction: float, seed: int | str
) -> DataFrame:
    """Exactly ``round(fraction * n)`` rows."""
    return sample_rows(df, id_column, round(fraction * df.count()), seed)


def split_by_hash(
    df: DataFrame, id_column: str, train_fraction: float, seed: int | str
) -> DataFrame:
    """Add ``split`` = train / test, about ``train_fraction`` in train, no shuffle."""
    eight = F.substring(draw_key(seed, id_column), 1, 8)
    is_train = eight < fraction_threshold(train_fraction)
    return df.withColumn("split", F.when(is_train, "train").otherwise("test"))


def split_exact(
    df: DataFrame, id_column: str, train_rows: int, seed: int | str
) -> DataFrame:
    """Add ``split``, with exactly ``train_rows`` rows in train.

    The draw of the last train row is found first; every row is then labelled by
    comparing its own draw with that one, so the table is not shuffled.
    """
    drawn = df.withColumn(DRAW, draw_key(seed, id_column))
    order = [DRAW, id_column]
    last = kth_key(drawn, order, train_rows, draw_bucket()) if train_rows > 0 else None
    if last is None:
        is_train = F.lit(train_rows > 0)
    else:
        is_train = up_to(order, last)
    return drawn.withColumn(
        "split", F.when(is_train, "train").otherwise("test")
    ).drop(DRAW)


def train_rows_70_30(total: int) -> int:
    """Train rows of the 70 % split: the whole part of 0.7 n in double precision.

    The double product is a little below the whole number for some n, such as 90.
    """
    return int(0.7 * total)


def train_rows_80_20(total: int) -> int:
    """Train rows of the 80 % split: the test part is rounded up."""
    return total - -(-total * 2 // 10)


def balance_classes(
    df: DataFrame, id_column: str, label_column: str, seed: int | str
) -> DataFrame:
    """Down-sample every class to the size of the smallest one.

    One aggregate counts the classes; each larger class then keeps its first rows
    in draw order (``first_rows``), and the smallest keeps all.
    """
    sizes = df.groupBy(label_column).agg(F.count(F.lit(1)).alias("n"))
    smallest = sizes.agg(F.min("n")).first()[0]
    if smallest is None:
        return df
    drawn = df.withColumn(DRAW, draw_key(seed, id_column))
    return first_rows_per_group(
        drawn, [DRAW, id_column], smallest, [label_column], draw_bucket()
    ).drop(DRAW)


def head_fraction(df: DataFrame, id_column: str, parts: int) -> DataFrame:
    """The first ``n // parts`` rows in id order."""
    return first_rows(df, [id_column], df.count() // parts)


def interleave(df: DataFrame, source_column: str, id_column: str) -> DataFrame:
    """Alternate pairs of rows from each source.

    Adds ``pair``: the row's position within its source, halved.  Sorting by
    ``pair``, source and id puts two rows of each source after one another.
    """
    numbered = ranked(df, [id_column], "_rank", [source_column])
    return numbered.withColumn("pair", F.floor((F.col("_rank") - 1) / 2)).drop("_rank")
