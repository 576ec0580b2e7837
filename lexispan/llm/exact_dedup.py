"""Exact deduplication as a stateful stream over digests, with a check of the full bytes.

The texts are reduced to ``(id, digest, locator)`` on the way in.  A streaming
aggregation whose keyed state lies on disk (RocksDB) and never expires keeps for each
digest the stable identifier of the row that stays, the place of its content and the
number of rows.  Digests that were hit more than once are looked up in the texts again
and grouped by all their bytes; should two different texts ever share a digest, they
are told apart there.  No Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.llm.columns import ascii_lower, drop_rows
from lexispan.llm.shared import new_path, stored

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Digests of 32 bytes that go to all tasks; more are joined by shuffle.
MAX_BROADCAST_HITS = 500_000
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def keyed_state(log: DataFrame, digest: str, id_col: str, files_per_batch: int | None) -> DataFrame:
    """``(digest, keep_id, keep_at, n)`` by a stream over the stored table ``log``.

    Every micro-batch writes the groups it changed to a folder of its own, so one that
    runs again after a failure replaces what it wrote.  The state only grows towards
    the largest id and the full count: the largest entry of a digest is the last one.
    """
    spark = log.sparkSession
    out = new_path(spark, "dedup-groups")
    reader = spark.readStream.schema(log.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    state = reader.parquet(log.stored_at).groupBy(digest).agg(
        F.max(F.struct(F.col(id_col).alias("keep_id"), F.col("locator").alias("keep_at"))).alias("keep"),
        F.count(F.lit(1)).alias("n"),
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    try:
        for key, value in STATE_SETTINGS.items():
            spark.conf.set(key, value)
        state.writeStream.outputMode("update").foreachBatch(write).trigger(
            availableNow=True
        ).option("checkpointLocation", new_path(spark, "dedup-state")).start().awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    if files_per_batch is None:
        changes = spark.read.schema(state.schema).parquet(out)
        return changes.select(digest, "keep.keep_id", "keep.keep_at", "n")
    changes = spark.read.schema(state.schema).parquet(out)
    return changes.groupBy(digest).agg(
        F.max("keep").alias("keep"), F.max("n").alias("n")
    ).select(digest, "keep.keep_id", "keep.keep_at", "n")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    normalise: Callable[[Column], Column] = ascii_lower,
    digest_of: Callable[[Column], Column] = sha256,
    files_per_batch: int | None = None,
) -> DataFrame:
    """``(id, digest, keep_id, group_size, kept)`` for every row of ``docs``.

    Texts are equal when ``normalise`` makes them byte for byte equal; of equal texts
    the largest id stays.  Null text counts as empty.  Rows with one id and one text
    are one document seen twice: both are counted and both carry ``kept``.  A null id
    never stays while its group has another one.  No rows give no rows; other columns
    of ``docs`` are not read.  ``files_per_batch`` cuts the stream into micro-batches.
    """
    texts = docs.select(
        F.col(id_col).alias("_id"), normalise(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"),
    )
    log = stored(
        texts.select("_id", digest_of(F.col("_text")).alias("_digest"),
                     F.input_file_name().alias("locator")),
        "dedup-log",
    )
    if log.isEmpty():
        groups = log.select("_digest", F.col("_id").alias("keep_id"), F.lit(0).cast("long").alias("n"))
    else:
        groups = keyed_state(log, "_digest", "_id", files_per_batch)
    # A narrow table; while it is small the texts are not shuffled to look its digests up.
    hits = stored(groups.filter("n > 1").select("_digest"), "dedup-hits")
    if hits.count() <= MAX_BROADCAST_HITS:
        hits = F.broadcast(hits)
    by_bytes = stored(
        texts.withColumn("_digest", digest_of(F.col("_text"))).join(hits, "_digest", "left_semi")
        .groupBy("_digest", "_text").agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        .groupBy("_digest").agg(F.count(F.lit(1)).alias("texts")),
        "dedup-bytes",
    )
    collided = by_bytes.filter("texts > 1").select("_digest")
    result = log.join(groups.select("_digest", "keep_id", "n"), "_digest").select(
        "_id", "_digest", "keep_id", "n"
    )
    if not collided.isEmpty():
        rows = texts.withColumn("_digest", digest_of(F.col("_text"))).join(collided, "_digest", "left_semi")
        told_apart = rows.groupBy("_digest", "_text").agg(
            F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
        )
        result = result.join(collided, "_digest", "left_anti").unionByName(
            rows.join(told_apart, ["_digest", "_text"]).select("_id", "_digest", "keep_id", "n")
        )
    return result.select(
        F.col("_id").alias(id_col), F.col("_digest").alias("digest"), "keep_id",
        F.col("n").alias("group_size"), F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of rows with equal texts the one with the largest id; all columns as they were.

    A row is dropped, never an id: others that share its id with another text stay.  Of
    equal rows, and of equal texts of which none has an id, one stays.
    """
    groups = exact_groups(docs, id_col, text_col).filter("group_size > 1")
    pairs = stored(groups.groupBy(F.col(id_col).alias("_id"), "digest").agg(
        F.count(F.lit(1)).alias("n"), F.first("kept").alias("kept")), "copies")
    digest = sha256(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))))
    return drop_rows(docs, id_col, digest, pairs.filter("NOT kept").select("_id", "digest"),
                     pairs.filter("kept AND n > 1").select("_id", "digest"))
