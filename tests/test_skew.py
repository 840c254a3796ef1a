"""Queries on tables where one key holds a third of the rows."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starlode.verification.compare import differences, duckdb_connection
from starlode.verification.frames import pages
from starlode.verification.oracle import ORACLE
from starlode.verification.queries import QUERIES
from tests.test_queries import SF_DIR

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason=f"no test tables in {SF_DIR}")

# Table -> column that gets one value on every third row.
HOT = {
    "lineitem": ("l_orderkey", 1),
    "orders": ("o_custkey", 5),
    "events": ("user_id", 1),
    "conversations": ("conv_id", 0),
    "supplier": ("s_nationkey", 3),
    "labels": ("doc_id", 0),
}
SKEWED = [
    "land_pages",
    "child_scan_parent_stamp",
    "distinct_parent_list",
    "missing_children",
    "page_completeness",
    "distinct_column",
    "latest_by_key",
    "latest_with_nulls_and_ties",
    "join_inner_using",
    "join_star_left",
    "join_detail_left",
    "fanout_guard",
    "bronze_children",
    "silver_user_types",
    "silver_evaluations_results",
    "dim_usuario",
    "fact_applied",
    "fact_results",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    duckdb = pytest.importorskip("duckdb")
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        if file.stem not in HOT:
            shutil.copy(file, folder)
            continue
        column, value = HOT[file.stem]
        rows = f"SELECT *, row_number() OVER () % 3 = 0 AS hot FROM '{file}'"
        kind = con.sql(f"SELECT typeof({column}) FROM '{file}' LIMIT 1").fetchall()[0][0]
        con.execute(
            f"COPY (SELECT * EXCLUDE (hot) REPLACE (if(hot, {value}, {column})::{kind} AS {column})"
            f" FROM ({rows})) TO '{folder / file.name}' (FORMAT parquet)"
        )
    return str(folder)


@pytest.mark.parametrize("name", SKEWED)
def test_hot_keys_change_no_result(spark, skewed, name):
    """With every join shuffled, so that hot keys do meet in one partition."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        result = QUERIES[name](spark, skewed)
        assert differences(result, duckdb_connection(skewed), ORACLE[name]) == []
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_pages_are_bounded_whatever_the_keys(spark):
    rows = spark.range(0, 1234, 1, 3).select("id", F.lit("hot").alias("k"))
    sizes = [r["n"] for r in pages(rows, ["id", "k"]).select(F.size("data").alias("n")).collect()]
    assert max(sizes) <= 100 and sum(sizes) == 1234 and sizes.count(0) == 1
