"""Word counts of a folder that files are added to, with state that outlives the query."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.operators.features import term_counts
from lexispan.sources.scratch import located

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def count_new_files(
    spark: SparkSession, source: str, schema: str, state: str,
    tokens: Callable[[DataFrame], DataFrame], terms: str = "tokens", group: Sequence[str] = ("label",),
    files_per_batch: int = 100,
) -> None:
    """Add the Parquet files below ``source`` that the folder ``state`` has not seen to its counts.

    ``tokens`` makes ``(group.., terms)`` of the rows, row by row.  Counts are kept on disk
    by key (RocksDB) and never expire.  Each micro-batch of ``files_per_batch`` files
    writes the counts it changed to a folder of its own, so that one that runs again after
    a failure replaces what it wrote.  The next call goes on where this one ended; no new
    files change nothing.  The number of shuffle partitions is that of the first call.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    counted = term_counts(tokens(rows), terms, list(group))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state}/counts/batch={number}")

    with _settings(spark, STATE_SETTINGS):
        counted.writeStream.outputMode("update").foreachBatch(write).trigger(availableNow=True).option(
            "checkpointLocation", f"{state}/checkpoint").start().awaitTermination()


def current_counts(spark: SparkSession, state: str, group: Sequence[str] = ("label",)) -> DataFrame:
    """``(group.., term, cnt)`` of all files counted so far.

    A count only grows, so the largest one written for a key is the last.
    """
    path, system = located(spark, f"{state}/counts")
    if not system.exists(path):
        raise FileNotFoundError(f"nothing was counted below {state}")
    changes = spark.read.parquet(f"{state}/counts")
    return changes.groupBy(*group, "term").agg(F.max("cnt").alias("cnt"))
