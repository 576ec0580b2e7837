"""Tables that an operator writes for its own later steps, on storage all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lexispan.session import ship_package

#: Of an Arrow batch that goes to a Python worker within ``small_batches``.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a folder of its own machine and
    any other one an error: executors could not see each other's files there.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="shared-")
    return _own_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody uses yet; removed when the driver ends."""
    ship_package(spark)
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop_path, system = located(spark, path)
    system.deleteOnExit(hadoop_path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    It cuts the lineage: a lost executor costs no earlier stage again.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside hand rows to Python in Arrow batches of at most ``BATCH_BYTES`` or a row.

    An executor holds several copies of a batch per core, outside its heap and in the worker.
    A lower limit of the caller stays, and so does theirs after the block; a frame that only
    runs later is not bounded.
    """
    before, now = spark.conf.getAll.get(_BATCH_SETTING), spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if 0 < now <= BATCH_BYTES:
        yield
        return
    spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)


def stored_by_batches(df: DataFrame, name: str) -> DataFrame:
    """``stored``, with ``small_batches`` to the Python functions of ``df``."""
    with small_batches(df.sparkSession):
        return stored(df, name)


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        hadoop_path, system = located(table.sparkSession, table.stored_at)
        system.delete(hadoop_path, True)


def located(spark: SparkSession, path: str):
    """``path`` as Hadoop knows it, and its file system."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
