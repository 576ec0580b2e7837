"""Reading tables and keeping intermediate results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.sources.scratch import located


#: A table of more bytes per core is read as it lies: it has splits enough.
MAX_SPREAD_BYTES = 128 << 20

_crowded: dict[tuple, bool] = {}


def scan(spark: SparkSession, path: str, *columns: str, spread_by: str | None = None) -> DataFrame:
    """Read the given columns of a Parquet table.

    Splits follow the row groups and ``spark.sql.files.maxPartitionBytes``.  With
    ``spread_by`` the rows of a small table, most of which lie in one row group, are dealt
    to all cores by that column; a larger table is never shuffled for it.
    """
    df = spark.read.parquet(path)
    wanted = df.select(*columns) if columns else df
    if spread_by is None or not _lies_crowded(spark, df, path):
        return wanted
    return wanted.repartition(spark.sparkContext.defaultParallelism, spread_by)


def _lies_crowded(spark: SparkSession, df: DataFrame, path: str) -> bool:
    """Whether one split has over twice its share of the rows of a small table.

    Neither files nor splits tell where the rows are, but a count per split does, and
    reads nothing but the footers of the files.
    """
    hadoop_path, system = located(spark, path)
    size, cores = system.getContentSummary(hadoop_path).getLength(), spark.sparkContext.defaultParallelism
    if cores < 2 or size > cores * MAX_SPREAD_BYTES:
        return False
    key = spark.sparkContext.applicationId, path, size, system.getFileStatus(hadoop_path).getModificationTime()
    if key not in _crowded:
        split = df.select("_metadata.file_path", "_metadata.file_block_start")
        most, rows = split.groupBy("file_path", "file_block_start").count().agg(
            F.max("count"), F.sum("count")).first()
        _crowded[key] = bool(rows) and most * cores > 2 * rows
    return _crowded[key]


def materialised(
    spark: SparkSession, path: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """The table stored at ``path``; built and written there if it is not complete.

    ``path`` lies on storage that all executors share.  A half-written table, one
    without its success marker, is written anew.
    """
    marker, system = located(spark, f"{path}/_SUCCESS")
    if not system.exists(marker):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` as the table ``name``, cut into ``buckets`` by ``key`` and sorted by it.

    Tables with the same key and number of buckets are joined, and grouped by the key,
    without being shuffled again.  Rows are brought together by key before they are
    written, so that each bucket is one file.  The table lies below the warehouse or at
    ``path``, on storage that all executors share, and replaces one of that name.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)
