"""Command line and session settings."""

from __future__ import annotations

import json

import pytest

from starlode.__main__ import main
from starlode.session import MIB, sizing
from tests.landed import RECORDS, land, write_pages


def test_single_loads(spark, lake, tmp_path):
    where = ["--bronze", lake.bronze, "--silver", lake.silver, "--gold", lake.gold, "--prefix", "p_"]
    write_pages(tmp_path / "items", RECORDS["items"])
    (report,) = main(["bronze", "items", "--landing", str(tmp_path), "--file-per-envelope", *where], spark)
    assert (report.table, report.rows) == (f"{lake.bronze}.p_items", 3)
    assert main(["silver", "items", "--keep", "all", *where], spark)[0].rows == 3
    (report,) = main(["silver", "items", *where], spark)
    assert (report.rows, report.source_rows) == (2, 3)
    (report,) = main(["gold", "dim_itens", "--key-method", "xxhash64", *where], spark)
    assert (report.mode, report.rows) == ("FULL", 2)


def test_everything_from_files(spark, lake, tmp_path):
    where = ["--bronze", lake.bronze, "--silver", lake.silver, "--gold", lake.gold]
    reports = main(
        ["all", "--landing", str(land(tmp_path)), "--file-per-envelope", "--parent-pattern", r"parent_(\d+)", *where],
        spark,
    )
    assert {r.table.split(".")[1]: r.rows for r in reports}["fato_checklists_aplicados_resultados"] == 4


def test_unknown_names_are_refused(spark):
    with pytest.raises(SystemExit):
        main(["silver", "countries"], spark)


def test_sizing_follows_the_volume():
    small, large = sizing(MIB, 8), sizing(100 * 1024**4, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(large["spark.sql.shuffle.partitions"]) == 100 * 1024 * 4
    same = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.files.maxPartitionBytes")
    assert all(small[k] == large[k] for k in same)
    assert large["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_loads_are_sized(spark, lake, tmp_path):
    """Settings of the session's start stay, the others follow the load."""
    land(tmp_path)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    where = ["--bronze", lake.bronze, "--silver", lake.silver, "--gold", lake.gold]
    main(["bronze", "items", "--landing", str(tmp_path), "--file-per-envelope", *where], spark)
    assert spark.conf.get(key) == str(256 * MIB)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    spark.conf.unset(key)


def test_new_files_only(spark, lake, tmp_path):
    where = ["--bronze", lake.bronze, "--silver", lake.silver, "--gold", lake.gold]
    (tmp_path / "items").mkdir()
    for number in (1, 2):
        page = {"data": [{"itemId": number}], "meta": {"hasMore": False}}
        (tmp_path / "items" / f"{number}.json").write_text(json.dumps(page))
        (report,) = main(
            ["bronze", "items", "--landing", str(tmp_path), "--state", str(tmp_path / "state"), *where], spark
        )
        assert report.rows == 1
    (report,) = main(["bronze", "items", "--landing", str(tmp_path), "--state", str(tmp_path / "state"), *where], spark)
    assert (report.mode, report.rows) == (None, 0)
    assert spark.table(f"{lake.bronze}.items").count() == 2
