"""Conforming, dimensions, facts and the guards of their keys."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from starlode.functions import status_label
from starlode.operators import (
    DecodeSpec,
    DimensionLink,
    DimensionSpec,
    EntitySpec,
    conform,
    decode_dimension,
    dimension,
    fanout_guard,
    key_collisions,
    link_dimensions,
    rename,
    require_unique,
)
from tests.conftest import plan_text

SPEC = EntitySpec(
    "thing", "id", {"id": "bigint", "name": "string", "size": "int", "at": "timestamp"},
    version="at", tolerant=frozenset({"size"}), rules={"name": lambda c: F.upper(c)},
)
DIM = DimensionSpec(
    "dim", "thing", "id", "sk", {"id": "natural", "name": "label"}, {"known": lambda: F.lit("yes")},
    ("natural", "known", "label"), "at",
)


def crc(text):
    return zlib.crc32(str(text).encode())


@pytest.fixture
def bronze(spark):
    return spark.createDataFrame(
        [
            ("1", "a", "5", "2024-01-01", "z"),
            ("1", "b", "x", "2024-01-02", "z"),
            ("2", "c", None, None, "z"),
            ("2", "c", None, None, "z"),
        ],
        "id string, name string, size string, at string, ignored string",
    )


def test_conform_types_cleans_and_keeps_the_newest(bronze):
    silver = conform(bronze, SPEC)
    assert silver.dtypes == [("id", "bigint"), ("name", "string"), ("size", "int"), ("at", "timestamp")]
    assert {tuple(r)[:3] for r in silver.collect()} == {(1, "B", None), (2, "C", None)}


def test_conform_other_policies(bronze):
    assert conform(bronze, SPEC, "all").count() == 4
    assert conform(bronze, SPEC, "any").count() == 2
    with pytest.raises(ValueError, match="keep"):
        conform(bronze, SPEC, "first")


def test_conform_is_idempotent(bronze):
    once = conform(bronze, SPEC)
    again = conform(once.select(*[F.col(c).cast("string") for c in once.columns]), SPEC)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))


def test_bad_text_in_a_survivor_raises_but_not_in_a_loser(spark):
    spec = EntitySpec("t", "id", {"id": "bigint", "n": "int", "at": "timestamp"}, version="at")
    rows = [("1", "bad", "2024-01-01"), ("1", "7", "2024-01-02")]
    schema = "id string, n string, at string"
    assert conform(spark.createDataFrame(rows, schema), spec).first()["n"] == 7
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(spark.createDataFrame(rows[:1], schema), spec).collect()


def test_decode_dimension_has_a_row_for_null(spark):
    spec = DecodeSpec("d", "s", "code", "sk", "natural", "label", status_label)
    df = spark.createDataFrame([(1,), (1,), (9,), (None,)], "code int")
    assert {tuple(r) for r in decode_dimension(df, spec).collect()} == {
        (crc(1), 1, "NÃO INICIADO"),
        (crc(9), 9, "DESCONHECIDO"),
        (None, None, "DESCONHECIDO"),
    }


def test_dimension_publishes_the_newest_row(spark):
    df = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", None)], "id long, name string, at int")
    dim = dimension(df, DIM)
    assert dim.columns == ["sk", "natural", "known", "label"]
    assert {tuple(r) for r in dim.collect()} == {(crc(1), 1, "yes", "new"), (crc(2), 2, "yes", "x")}


def test_dimension_of_a_unique_silver_needs_no_shuffle(spark):
    spec = DimensionSpec("dim", "thing", "id", "sk", {"id": "natural"}, newest=False)
    df = spark.range(0, 6, 1, 3).selectExpr("id % 3 AS id")
    dim = dimension(df, spec)
    assert "Exchange" not in plan_text(dim) and dim.count() == 6


def test_dimension_filter_and_enrichment_follow_the_ranking(spark):
    df = spark.createDataFrame([(1, "keep", 1), (1, "drop", 2), (2, "keep", 1)], "id long, name string, at int")
    assert [r["natural"] for r in dimension(df, DIM, where=F.col("name") != "drop").collect()] == [2]
    known = spark.createDataFrame([("keep",)], "name string")
    assert [r["natural"] for r in dimension(df, DIM, enrich=lambda d: d.join(known, "name")).collect()] == [2]


@pytest.fixture
def fact(spark):
    return spark.createDataFrame([(1, 10), (2, 99), (3, None), (4, 10)], "f long, k long")


def test_links_keep_every_fact_row(spark, fact):
    dims = {"d": spark.createDataFrame([(10, 7), (11, 8), (None, 9)], "n long, sk long")}
    linked = link_dimensions(fact, [DimensionLink("d", "k", "n", "sk")], dims)
    assert {tuple(r) for r in linked.collect()} == {(1, 10, 7), (2, 99, None), (3, None, None), (4, 10, 7)}
    null_safe = link_dimensions(fact, [DimensionLink("d", "k", "n", "sk", null_safe=True)], dims)
    assert (3, None, 9) in {tuple(r) for r in null_safe.collect()}


def test_a_duplicate_dimension_key_multiplies_rows_and_is_found(spark, fact):
    dim = spark.createDataFrame([(10, 7), (10, 7), (11, 8), (None, 1), (None, 1)], "n long, sk long")
    assert link_dimensions(fact, [DimensionLink("d", "k", "n", "sk")], {"d": dim}).count() == 6
    assert [tuple(r) for r in fanout_guard(dim, "n").collect()] == [(10, 2)]
    with pytest.raises(ValueError, match="n=10 occurs 2 times"):
        require_unique(dim, "n")
    require_unique(dim.dropDuplicates(["n"]), "n")


def test_hot_foreign_keys_are_split_at_run_time(spark):
    """Two shuffled links in a row, a third of the rows on one key, another third null."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id"))
        fact = spark.range(0, 60_000, 1, 6).select(
            "id", hot.alias("a"), hot.alias("b"), F.repeat(F.lit("x"), 20).alias("wide")
        )
        dim = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("n"))
        dims = {
            "a": dim.select("n", (F.col("n") + 1).alias("sk_a")),
            "b": dim.select("n", (F.col("n") + 2).alias("sk_b")),
        }
        links = [DimensionLink("a", "a", "n", "sk_a"), DimensionLink("b", "b", "n", "sk_b")]
        linked = link_dimensions(fact, links, dims)
        rows = linked.collect()
        assert len(rows) == 60_000
        assert all(r.sk_a == (None if r.a is None else r.a + 1) for r in rows)
        assert all(r.sk_b == (None if r.b is None else r.b + 2) for r in rows)
        assert plan_text(linked).count("skew=true") >= 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_small_dimensions_are_broadcast_by_size_without_a_hint(spark, fact, tmp_path):
    spark.range(100).select(F.col("id").alias("n"), F.col("id").alias("sk")).write.parquet(str(tmp_path / "d"))
    dims = {"d": spark.read.parquet(str(tmp_path / "d"))}
    linked = link_dimensions(fact, [DimensionLink("d", "k", "n", "sk")], dims)
    assert "BroadcastHashJoin" in plan_text(linked)
    assert "ResolvedHint" not in linked._jdf.queryExecution().analyzed().toString()


def test_crc_collisions_are_found(spark):
    """Two texts of equal crc32, found by search over short words."""
    seen, pair, n = {}, None, 0
    while pair is None:
        word = f"k{n * 2654435761 % 2**32:x}{n}"
        pair = (seen[c], word) if (c := crc(word)) in seen else None
        seen[c] = word
        n += 1
    df = spark.createDataFrame([(pair[0],), (pair[1],), (pair[1],), ("other",)], "k string")
    assert [tuple(r) for r in key_collisions(df, "k").collect()] == [(crc(pair[0]), 2)]
    assert key_collisions(df, "k", "xxhash64").count() == 0


def test_rename_keeps_order(spark):
    assert rename(spark.range(1).selectExpr("id", "1 AS x", "2 AS y"), {"y": "b", "id": "a"}).columns == ["b", "a"]
