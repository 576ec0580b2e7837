"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            if v.is_integer():
                return int(v)
            return "nan" if math.isnan(v) else v
        return v

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both results have the same columns and rows."""
    relation = con.sql(sql)
    if sorted(spark_df.columns) != sorted(relation.columns):
        return f"columns: {spark_df.columns} / {relation.columns}"
    ours = canonical([tuple(r) for r in spark_df.collect()], spark_df.columns)
    theirs = canonical(relation.fetchall(), relation.columns)
    if len(ours) != len(theirs):
        return f"rows: {len(ours)} / {len(theirs)}"
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        return f"{len(different)} of {len(ours)} rows differ, first: {different[0]}"
    return None
