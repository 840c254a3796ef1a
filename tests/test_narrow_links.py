"""Facts send key and foreign keys through their links, and no whole row."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starlode.operators.conform import conform
from starlode.operators.dedup import latest_text_by_key
from starlode.operators.star import DimensionLink, link_dimensions
from starlode.plans.entities import SILVER
from starlode.plans.star_schema import FACTS, ROW_KEY, build_fact
from tests.test_dedup import _metrics

LINKS = [DimensionLink("d", "a", "n", "sk_d"), DimensionLink("e", "b", "n", "sk_e", null_safe=True)]


@pytest.fixture
def shuffled_joins(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def test_links_by_row_key_are_those_of_whole_rows(spark, shuffled_joins):
    rows = [("1", "x", None), ("1", "y", "q"), (None, "x", "q"), ("", None, None), ("\x01", "x", "r"), ("01", "z", "q")]
    fact = latest_text_by_key(spark.createDataFrame(rows, "k string, a string, b string"), "k", row_key=ROW_KEY)
    assert fact.count() == fact.select(ROW_KEY).distinct().count() == 5
    assert fact.where(F.col(ROW_KEY).isNull()).isEmpty()
    dims = {  # keys that repeat give as many rows as they do without a row key
        "d": spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), (None, 4)], "n string, sk_d long"),
        "e": spark.createDataFrame([("q", 5), (None, 6)], "n string, sk_e long"),
    }
    plain = link_dimensions(fact, LINKS, dims).drop(ROW_KEY)
    narrow = link_dimensions(fact, LINKS, dims, ROW_KEY).drop(ROW_KEY)
    assert sorted(map(repr, narrow.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_links_ship_no_whole_row(spark, shuffled_joins, tmp_path):
    spec, fact = SILVER["evaluations_results"], FACTS["fato_checklists_aplicados_resultados"]
    own = {c: F.col("id").cast("string") for c in (spec.key, *(link.foreign for link in fact.links))}
    own["text"] = F.repeat(F.lit("resposta "), 200)
    spark.range(500).select(
        *[own.get(c, F.lit(None).cast("string")).alias(c) for c in spec.types]
    ).write.parquet(f"{tmp_path}/bronze")
    bronze = spark.read.parquet(f"{tmp_path}/bronze")
    dims = {
        link.dimension: spark.range(500).select(
            F.col("id").cast(spec.types[link.foreign]).alias(link.natural), F.col("id").alias(link.surrogate)
        )
        for link in fact.links
    }
    made = build_fact(fact.name, lambda _: conform(bronze, spec, row_key=ROW_KEY), dims.__getitem__)
    found = made.collect()
    assert len(found) == 500 and all(r[link.surrogate] == r[fact.natural] for r in found for link in fact.links)
    sizes = sorted(_metrics(made, "dataSize"))
    # whole rows are shuffled for the dedup, which both sides of the last join read
    assert sum(n > 500 * 1800 for n in sizes) <= 2 and sum(n for n in sizes if n < 500 * 1800) < 500 * 1800


def test_only_chosen_rows_have_a_key(spark):
    rows = spark.createDataFrame([("1",)], "resultId string")
    with pytest.raises(ValueError, match="no key of their own"):
        conform(rows, SILVER["evaluations_results"], "all", ROW_KEY)
