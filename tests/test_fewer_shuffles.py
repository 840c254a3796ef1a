"""Steps of incremental loads that need no shuffle, or one where there were two."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from starlode.operators import buckets
from starlode.operators.dedup import dealt_text
from starlode.verification.frames import pages
from tests.test_dedup import _metrics
from tests.test_narrow_rows import ODD


def test_pages_are_cut_without_a_shuffle(spark):
    rows = spark.range(0, 25_050, 1, 2).select("id", F.when(F.col("id") % 3 != 0, F.lit("é")).alias("t"))
    made = pages(rows, ["t", "id"])
    found = made.collect()
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert all(len(p["data"]) <= 100 and p["meta"]["hasMore"] == (len(p["data"]) > 0) for p in found)
    assert sorted((r["id"], r["t"]) for p in found for r in p["data"]) == [(i, "é" if i % 3 else None) for i in range(25_050)]
    assert pages(rows.where("id < 0"), ["id"]).count() == 1


def test_dealt_rows_stay_as_they_are(spark):
    rows = [(a, i % 3 if i % 4 else None, b) for i, (a, b) in enumerate(itertools.product(ODD, ODD))]
    df = spark.createDataFrame(rows, "a string, n int, b string")
    for one in (df, df.withColumn("m", F.col("n") + 1)):  # the latter is not all text
        dealt = dealt_text(one, "n")
        assert dealt.columns == one.columns and sorted(map(repr, dealt.collect())) == sorted(map(repr, one.collect()))
        places = dealt.select("n", F.spark_partition_id().alias("p")).distinct().groupBy("n").count()
        assert {r["count"] for r in places.collect()} == {1}
    wide = spark.range(1000).select((F.col("id") % 4).alias("n"), *[F.lit("x").alias(f"c{i}") for i in range(20)])
    assert len(dealt_text(wide, "n").collect()) == 1000
    dealt = dealt_text(wide, "n")
    dealt.collect()
    assert max(_metrics(dealt, "dataSize")) < 1000 * 16 * 20


def test_dealt_buckets_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    rows = dealt_text(spark.range(40).select(F.col("id").cast("string").alias("k"), (F.col("id") % 4).cast("int").alias("b")), "b")
    rows.write.parquet(f"{tmp_path}/dealt")
    rows = spark.read.parquet(f"{tmp_path}/dealt")
    shuffles = []
    monkeypatch.setattr(type(rows), "repartition", lambda *_: shuffles.append(1))
    store = buckets.BucketStore("default.dealt_once", f"{tmp_path}/store")
    buckets.commit_buckets(spark, [store], [rows], None, range(4), "b", 4, "s", 1, dealt=True)
    found = spark.read.table("default.dealt_once").collect()
    spark.sql("DROP TABLE default.dealt_once")
    assert not shuffles and sorted((int(r["k"]), r["b"]) for r in found) == [(i, i % 4) for i in range(40)]
