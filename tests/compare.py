"""Compare queries with their SQL: ``python tests/compare.py DIR [name ...]``."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from comparison import difference, oracle_connection  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def main(sf_dir: str, names: list[str]) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            sql = oracle_sql().get(name)
            if sql is None:
                found = f"rows only: {len(df.collect())}"
            else:
                found = difference(df, con, sql) or "ok"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found != "ok" and not found.startswith("rows only")
        print(f"{name:28s} {time.time() - start:6.2f}s  {found}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
