"""Rows that go through a dedup as one text come out as they went in."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from starlode.operators.conform import conform
from starlode.operators.dedup import latest_by_key, latest_text_by_key, typed_version
from starlode.plans.entities import SILVER
from tests.test_dedup import _metrics

ODD = [None, "", "a", "ab", "\x00", "\x00\x00", "\x01", "\x01\x00", "\x00\x01", "\x01\x02", "\x02", "a\x00", "a\x01b", "é", "😀", " "]


def test_packed_rows_rank_and_read_as_columns(spark):
    rows = [(i, k, a, b) for k in ("k", None, "") for i, (a, b) in enumerate(itertools.product(ODD, ODD))]
    df = spark.createDataFrame(rows, "i long, k string, a string, b string")
    for shift in (0, 7, 100):  # other rows of the same table win
        part = df.where(F.col("i") % 200 >= shift).select("a", "k", "b")
        alone = df.where(F.col("i") >= shift).select(F.concat_ws("-", "i", "k").alias("k"), "a", "b")
        for one in (part, alone):
            expected = sorted(map(repr, latest_by_key(one, "k").collect()))
            got = latest_text_by_key(one, "k")
            assert got.columns == one.columns and sorted(map(repr, got.collect())) == expected


def test_packed_rows_rank_by_version_first(spark):
    df = spark.createDataFrame(
        [("k", "10", "a"), ("k", "9", "z"), ("k", "x", "zz"), ("n", None, "a"), ("n", None, None)],
        "k string, v string, t string",
    )
    got = latest_text_by_key(df, "k", typed_version("v", "int"))
    assert {tuple(r) for r in got.collect()} == {("k", "10", "a"), ("n", None, "a")}


def test_silver_ships_narrow_rows(spark):
    """24 columns of text take less than 8 bytes each for their places alone."""
    spec = SILVER["evaluations_results"]
    text = {c: F.col("id").cast("string") for c in ("resultId", "evaluationId", "number")}
    rows = spark.range(2000).select(*[text.get(c, F.lit(None).cast("string")).alias(c) for c in spec.types])
    made = conform(rows, spec)
    assert made.count() == 2000
    made.collect()
    assert max(_metrics(made, "dataSize")) < 2000 * 8 * len(spec.types)
