"""A registry of surrogate keys that no two natural keys share.

A natural key's surrogate is the crc32 of its text as long as it is the first with that value;
those that collide with earlier ones get further values, the crc32 plus a multiple of 2 ** 32.
Keys keep what they were given: the registry is a table that grows by whole loads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlode.functions.keys import surrogate_key
from starlode.operators.load import open_table
from starlode.operators.loads import Load, Overtaken, append_load, ledger, replace_loads
from starlode.sources.shared import materialize

_SPAN = 1 << 32
_ATTEMPTS = 5


def _text(key: Column | str) -> Column:
    return (F.col(key) if isinstance(key, str) else key).cast("string")


def unregistered(keys: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """natural, base, rank of the keys that ``known`` (the same columns) lacks.

    Ranks go on from those of the same base, in the order of the keys' texts, so equal input gives
    equal keys however it is partitioned. A base has as many rows as keys that collide: few.
    """
    own = keys.select(_text(key).alias("natural")).where(F.col("natural").isNotNull()).distinct()
    new = own.join(known.select("natural"), "natural", "left_anti")
    new = new.withColumn("base", surrogate_key("natural"))
    taken = known.groupBy("base").agg((F.max("rank") + 1).alias("_taken"))
    place = F.row_number().over(Window.partitionBy("base").orderBy("natural")) - 1
    ranked = new.withColumn("_place", place).join(taken, "base", "left")
    return ranked.select("natural", "base", (F.col("_place") + F.coalesce("_taken", F.lit(0))).cast("long").alias("rank"))


def register_keys(spark: SparkSession, table: str, root: str, keys: DataFrame, key: str) -> int:
    """Give every key of ``keys`` that ``table`` lacks a surrogate; the number of new ones.

    ``root`` is the folder for the table's rows. Null keys get none. Of two calls at once the
    later one plans anew, so no key is given twice.
    """
    for _ in range(_ATTEMPTS):
        before = ledger(spark, table)
        if before is None:
            known = spark.createDataFrame([], "natural string, base long, rank long")
        else:
            known = open_table(spark, table)
        new = materialize(unregistered(keys, key, known), "new-keys")
        if before is None:
            return replace_loads(spark, table, Load(new), root)
        if new.isEmpty():
            return 0
        try:
            return append_load(spark, table, Load(new), before)
        except Overtaken:
            continue
    raise Overtaken(table)


def registered_key() -> Column:
    """The surrogate of a row of the registry."""
    return F.col("base") + F.col("rank") * F.lit(_SPAN)


def with_registered_key(df: DataFrame, key: str, registry: DataFrame, name: str) -> DataFrame:
    """``df`` with the surrogate of ``key`` in ``name``; null where the key is null or unknown."""
    keys = registry.select(F.col("natural").alias("_natural"), registered_key().alias(name))
    return df.join(keys, _text(key) == F.col("_natural"), "left").drop("_natural")
