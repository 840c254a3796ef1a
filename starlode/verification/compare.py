"""Run a query and its SQL twin on the same files and compare them row by row."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

from pyspark.sql import DataFrame


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def bag(columns, rows) -> Counter:
    """Multiset of rows with the columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(result: DataFrame, con, sql: str) -> list[str]:
    """What differs between a result and its SQL twin, nothing if they are equal."""
    relation = con.sql(sql)
    if sorted(result.columns) != sorted(relation.columns):
        return [f"columns {sorted(result.columns)} / {sorted(relation.columns)}"]
    ours = bag(result.columns, result.collect())
    theirs = bag(relation.columns, relation.fetchall())
    return [f"only in Spark: {row}" for row in list((ours - theirs).elements())[:3]] + [
        f"only in DuckDB: {row}" for row in list((theirs - ours).elements())[:3]
    ]
