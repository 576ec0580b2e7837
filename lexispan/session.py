"""What a session holds for the queries: the shipped package and kept tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

_shipped: set[str] = set()
_kept: dict[str, list[DataFrame]] = {}


def keep(df: DataFrame) -> DataFrame:
    """Persist a table that one query reads several times, until ``release_kept``."""
    application = df.sparkSession.sparkContext.applicationId
    _kept.setdefault(application, []).append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return df


def release_kept(spark: SparkSession) -> None:
    """Free what earlier queries of this application kept.

    A frame that was built but has not run yet stays right; it computes its table
    again.  What an application kept that has ended is gone with it.
    """
    for df in _kept.pop(spark.sparkContext.applicationId, []):
        df.unpersist()
    _kept.clear()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of the session, once per application.

    Needed where it is neither installed there nor given with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
