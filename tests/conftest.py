import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

PATHS = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]
sys.path[:0] = PATHS
# Functions of the test modules run in Python workers, too.
os.environ["PYTHONPATH"] = os.pathsep.join([*PATHS, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
