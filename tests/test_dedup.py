"""Distinct and newest-row operators against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starlode.operators import any_by_key, distinct_values, latest_by_key
from starlode.operators.dedup import typed_version
from tests.conftest import plan_text


def sample(seed: int, rows: int = 400):
    """Few keys, one of them holding a third of the rows; null keys and versions, ties."""
    pick = random.Random(seed)
    return [
        (
            "hot" if pick.random() < 0.34 else pick.choice([None, "a", "b", "c", "d"]),
            pick.choice([None, "2024-01-01", "2024-01-02", "2023-12-31"]),
            pick.choice([None, "x", "y", "é"]),
            pick.choice([None, 1, 2]),
        )
        for _ in range(rows)
    ]


def newest(rows):
    """Largest version, then the larger remaining columns; null is the smallest."""
    best = {}
    for key, *rest in rows:
        order = [(v is not None, v) if v is not None else (False,) for v in rest]
        if key not in best or order > best[key][0]:
            best[key] = (order, (key, *rest))
    return {row for _, row in best.values()}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("partitions", [1, 7])
def test_latest_matches_brute_force(spark, seed, partitions):
    rows = sample(seed)
    df = spark.createDataFrame(rows, "k string, v string, t string, n int").repartition(partitions)
    got = [tuple(r) for r in latest_by_key(df, "k", "v").collect()]
    assert len(got) == len(set(got)) and set(got) == newest(rows)


def test_latest_without_version_and_payload(spark):
    df = spark.createDataFrame([(1, "b"), (1, "c"), (2, None)], "k int, t string")
    assert {tuple(r) for r in latest_by_key(df, "k").collect()} == {(1, "c"), (2, None)}
    assert sorted(r.k for r in latest_by_key(df.select("k"), "k").collect()) == [1, 2]


def test_latest_keeps_column_order_and_takes_several_keys(spark):
    df = spark.createDataFrame([(1, "a", 1), (5, "a", 1), (3, "a", 2)], "v int, k string, j int")
    got = latest_by_key(df, ["k", "j"], "v")
    assert got.columns == ["v", "k", "j"]
    assert {tuple(r) for r in got.collect()} == {(5, "a", 1), (3, "a", 2)}


def test_typed_version_ranks_by_instant_not_by_text(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01T00:30:00+02:00", "older"), (1, "2023-12-31T23:00:00Z", "newer"), (1, "soon", "bad")],
        "k int, v string, t string",
    )
    assert latest_by_key(df, "k", typed_version("v", "timestamp")).first()["t"] == "newer"


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with two thirds of all rows ships at most one row per map task."""
    key = F.when(F.col("id") % 3 != 0, "hot").otherwise("cold")
    hot = spark.range(0, 20_000, 1, 5).select(key.alias("k"), F.col("id").alias("v"))
    result = latest_by_key(hot, "k", "v")
    assert {r["k"]: r["v"] for r in result.collect()} == {"hot": 19_999, "cold": 19_998}
    assert plan_text(result).count("WindowGroupLimit") >= 2
    shuffled = _metrics(result, "shuffleRecordsWritten")
    assert shuffled and max(shuffled) <= 10


def _metrics(df, metric: str) -> list[int]:
    """Values of an exchange metric in the executed plan."""
    found = []

    def walk(plan):
        name = plan.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(plan.executedPlan())
        if name.endswith("QueryStage"):
            return walk(plan.plan())
        if name.startswith("Exchange") and plan.metrics().contains(metric):
            found.append(plan.metrics().apply(metric).value())
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))
        return None

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_any_by_key_keeps_whole_rows(spark):
    rows = [r for r in sample(9) if r[0]]
    df = spark.createDataFrame(rows, "k string, v string, t string, n int")
    got = [tuple(r) for r in any_by_key(df, "k").collect()]
    assert sorted(r[0] for r in got) == sorted({r[0] for r in rows}) and set(got) <= set(rows)


def test_distinct_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a")], "i int, t string")
    assert distinct_values(df, "i", "t").count() == 2
    assert distinct_values(df, "t").count() == 1
