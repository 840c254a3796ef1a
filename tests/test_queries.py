"""Every registered query against its SQL twin, and the shape of its plan."""

from __future__ import annotations

import os
import re

import pytest

from starlode.verification.compare import differences, duckdb_connection
from starlode.verification.oracle import ORACLE
from starlode.verification.queries import QUERIES
from tests.conftest import plan_text

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason=f"no test tables in {SF_DIR}")


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    return duckdb_connection(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


# Operators that pass whole tables to one task, repeat one side per row of the other,
# or leave the JVM.
BANNED = re.compile(
    r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas"
    r"|FlatMapGroupsInPandas|CollectLimit|LocalLimit|GlobalLimit|TakeOrdered|Sample"
)
# Global aggregates: one partial row per task may meet in one task.
GLOBAL = re.compile(r"HashAggregate\(keys=\[\]|SortAggregate\(key=\[\]")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    assert differences(result, duck, ORACLE[name]) == []
    plan = plan_text(result)
    assert not BANNED.search(plan), plan
    assert "SinglePartition" not in plan or GLOBAL.search(plan), plan


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("silver_items", 2),  # p_partkey, p_name, p_size and nothing else
        ("join_detail_left", 4),
        ("fanout_guard", 2),
        ("dim_status", 1),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    plan = plan_text(QUERIES[name](spark, SF_DIR))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert len(schema.split(",")) <= columns + 2, plan


def test_entry(spark):
    import __spark_entry__ as contract

    result = contract.entry(spark)
    assert result.count() > 0 and "sk_status" in result.columns
    assert set(QUERIES) <= contract.oracle_sql().keys() <= contract.queries().keys()
