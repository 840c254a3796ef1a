"""Checks of keys before a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlode.functions.keys import surrogate_key


def fanout_guard(dim: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once and would multiply fact rows; null never joins."""
    return (
        dim.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def require_unique(dim: DataFrame, key: str, name: str = "dimension") -> None:
    found = fanout_guard(dim, key).first()
    if found is not None:
        raise ValueError(f"{name}: {key}={found[key]!r} occurs {found['copies']} times")


def key_collisions(df: DataFrame, key: str, method: str = "crc32") -> DataFrame:
    """Surrogate keys shared by several natural keys."""
    return (
        df.select(key)
        .filter(F.col(key).isNotNull())
        .distinct()
        .groupBy(surrogate_key(key, method).alias("surrogate"))
        .agg(F.count(F.lit(1)).alias("natural_keys"))
        .filter(F.col("natural_keys") > 1)
    )


def key_faults(df: DataFrame, key: str, surrogate: str) -> tuple[int, int]:
    """Natural keys that occur more than once, and surrogate keys shared by several of them."""
    per_key = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"), F.min(surrogate).alias("surrogate"))
    )
    per_surrogate = per_key.groupBy("surrogate").agg(
        F.count_if(F.col("copies") > 1).alias("repeated"), F.count(F.lit(1)).alias("keys")
    )
    found = per_surrogate.agg(
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("repeated"),
        F.count_if(F.col("keys") > 1).alias("shared"),
    ).first()
    return found["repeated"], found["shared"]
