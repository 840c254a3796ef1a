"""Load control and the table sink."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from starlode.functions import STAMP
from starlode.operators import (
    LoadPlan,
    counted,
    newer_than,
    plan_load,
    stamp_load,
    without_stamp,
    write_table,
)
from starlode.operators.load import set_table_properties, watermark_key
from tests.conftest import plan_text


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def test_plan_load_in_order_of_the_rules(spark, name):
    assert plan_load(spark, name, "day") == LoadPlan("FULL")
    spark.createDataFrame([("2024-01-02", None), ("2024-01-10", None)], "day string, empty string").write.saveAsTable(name)
    assert plan_load(spark, name, "day", force_full=True) == LoadPlan("FULL")
    assert plan_load(spark, name) == LoadPlan("FULL")
    assert plan_load(spark, name, "") == LoadPlan("FULL")
    assert plan_load(spark, name, "empty") == LoadPlan("FULL")
    assert plan_load(spark, name, "day") == LoadPlan("INCREMENTAL", "2024-01-10")


def test_watermark_of_text_compares_as_text(spark, name):
    spark.createDataFrame([("9",), ("10",)], "v string").write.saveAsTable(name)
    assert plan_load(spark, name, "v").watermark == "9"


def test_newer_than_is_strict_unless_told(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "v string")
    assert [r.v for r in newer_than(df, "v", "b").collect()] == ["c", None]
    assert [r.v for r in newer_than(df, "v", "b", inclusive=True).collect()] == ["b", "c", None]


def test_newer_than_by_type(spark):
    days = ["2024-01-01T00:00:00", "2024-01-01 12:00:00", "2024-01-02", "no day"]
    df = spark.createDataFrame([(d,) for d in days], "v string")
    by_text, by_time = (
        [r.v for r in newer_than(df, "v", "2024-01-01 08:00:00", data_type=t).collect()] for t in (None, "timestamp")
    )
    assert by_text == days and by_time == days[1:]


def test_the_watermark_is_stored_with_the_table(spark, name):
    spark.createDataFrame([("2024-01-02",)], "day string").write.saveAsTable(name)
    set_table_properties(spark, name, {watermark_key("day"): "2024-05-05"})
    assert plan_load(spark, name, "day") == LoadPlan("INCREMENTAL", "2024-05-05")


@pytest.mark.parametrize("external", [False, True])
def test_a_failing_overwrite_leaves_the_old_rows(spark, name, tmp_path, external):
    path = str(tmp_path / "t") if external else None
    write_table(spark.range(3), name, path=path)
    with pytest.raises(Exception, match="stop"):
        write_table(spark.range(5).select(F.raise_error(F.lit("stop")).cast("long").alias("id")), name, path=path)
    assert spark.table(name).count() == 3
    write_table(spark.range(7), name, path=path)
    write_table(spark.range(2), name, "INCREMENTAL", path=path)
    assert spark.table(name).count() == 9
    if external:
        assert len(list((tmp_path / "t").glob("v-*"))) == 2  # the failed attempt's and the current


def test_delta_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("a", 1, 2)], "v string, x int, y int").write.parquet(str(tmp_path / "p"))
    plan = plan_text(newer_than(spark.read.parquet(str(tmp_path / "p")), "v", "b").select("v", "x"))
    assert "GreaterThan(v,b)" in plan and "ReadSchema: struct<v:string,x:int>" in plan


def test_full_overwrites_and_everything_else_appends(spark, name):
    df = spark.createDataFrame([(1, "a")], "i int, v string")
    assert write_table(df, name) == 1
    write_table(df, name)
    assert spark.table(name).count() == 1
    write_table(df.select("v", "i"), name, "INCREMENTAL")
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "a")] * 2


def test_external_table(spark, name, tmp_path):
    write_table(spark.range(3), name, path=str(tmp_path / "ext"))
    assert spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "ext")).count() == 3


def test_bucketed_tables_join_without_a_shuffle(spark):
    names = [f"b_{uuid.uuid4().hex}" for _ in range(2)]
    for table in names:
        assert write_table(spark.range(0, 1000, 1, 7), table, bucket_by=(4, "id")) == 1000
    location = spark.sql(f"DESCRIBE FORMATTED {names[0]}").filter("col_name = 'Location'").first()["data_type"]
    assert len(spark.read.parquet(location).inputFiles()) == 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(names[0]).join(spark.table(names[1]), "id")
        assert joined.count() == 1000
        assert "Exchange hashpartitioning" not in plan_text(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stamp_and_strip(spark):
    stamped = stamp_load(spark.range(2))
    assert stamped.schema[STAMP].dataType.simpleString() == "timestamp"
    assert stamped.filter(F.col(STAMP).isNull()).count() == 0
    assert without_stamp(stamped).columns == ["id"]
    assert without_stamp(spark.range(1)).columns == ["id"]


def test_rows_are_counted_while_written(spark, name):
    rows, seen = counted(spark.range(0, 123, 1, 5), name, big=F.max("id"))
    assert write_table(rows, name) == 123
    assert seen.get == {"rows": 123, "big": 122}
