"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys of an id and a digest of 32 bytes that go to all tasks; more are joined by shuffle.
MAX_BROADCAST_KEYS = 500_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` does the same on text of single-byte characters and is faster there.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def word_count(text: Column) -> Column:
    """Number of runs of characters other than blank, tab, LF, VT, FF and CR; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with as many underscores before it as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def drop_rows(df: DataFrame, id_col: str, digest: Column, dropped: DataFrame, repeated: DataFrame) -> DataFrame:
    """``df`` without some rows, all columns as they were.

    Rows are known by their id, which may be null or repeated, and the ``digest`` of their
    text.  Those whose two are in ``dropped`` go; of those in ``repeated``, which stand in
    ``df`` several times, one stays.  Both tables are ``(id, digest)`` with every pair once
    and stored; while one is small, the texts are not shuffled to look its keys up.
    """
    key, other, mark = (free_name(df, name) for name in ("digest", "other_digest", "other_id"))
    keyed = df.withColumn(key, digest)

    def among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        same = (F.col(key) == F.col(other)) & F.col(id_col).eqNullSafe(F.col(mark))
        keys = keys.toDF(mark, other)
        return rows.join(F.broadcast(keys) if keys.count() <= MAX_BROADCAST_KEYS else keys, same, how)

    left = among(keyed, dropped, "left_anti")
    if not repeated.isEmpty():
        left = among(left, repeated, "left_anti").unionByName(
            among(left, repeated, "left_semi").dropDuplicates([id_col, key]))
    return left.drop(key)
