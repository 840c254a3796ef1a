"""Distinct and one-row-per-key operators; all of them combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_by_key(
    df: DataFrame, keys: str | Sequence[str], version: str | Column | None = None
) -> DataFrame:
    """The newest row of every key, the same one on every run.

    Rows are ranked by ``version`` (nulls last), then by all columns from left to
    right (nulls last), so that the survivor never depends on the partitioning. Null
    is a key like any other. Spark turns rank-and-keep-first into a group limit below
    the exchange: map tasks keep one row per key, hence a key with a third of all
    rows ships one row per task. (Measured faster than the maximum of a struct, which
    sorts as well but aggregates without code generation for its buffers.)
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    rank = [_ordered(df, c) for c in payload]
    if version is not None:
        rank.insert(0, F.col(version) if isinstance(version, str) else version)
    newest_first = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in rank])
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def _ordered(df: DataFrame, column: str) -> Column:
    """A map has no order; its sorted entries do."""
    if isinstance(df.schema[column].dataType, T.MapType):
        return F.array_sort(F.map_entries(column))
    return F.col(column)


def latest_text_by_key(
    df: DataFrame, key: str, version: Column | None = None, row_key: str | None = None
) -> DataFrame:
    """What :func:`latest_by_key` keeps of a frame of text columns, by narrower rows.

    Below the exchange all columns but the key travel as one text that sorts as they do from left
    to right, nulls last when descending. A row of two dozen short texts is less than half as wide so, and
    is sorted twice. Columns must be well-formed UTF-8.

    ``row_key`` adds a column of this name that tells the rows apart and is never null: the packed
    key. The rows are partitioned by it, so what joins them by it moves no row of theirs.
    """
    payload = [c for c in df.columns if c != key]
    if row_key is not None:
        keyed = df.withColumn(row_key, _packed(key)).drop(key)
        newest = latest_text_by_key(keyed, row_key, version)
        return newest.select(*[_unpacked(F.col(row_key))[0].alias(c) if c == key else c for c in df.columns], row_key)
    if not payload:
        return latest_by_key(df, key)
    first = [] if version is None else [version.alias("_version")]
    packed = F.concat(*[_packed(c) for c in payload]).alias("_packed")
    newest = latest_by_key(df.select(key, *first, packed), key)
    parts = newest.select(key, _unpacked(F.col("_packed")).alias("_parts"))
    position = {c: i for i, c in enumerate(payload)}
    return parts.select(*[c if c == key else F.col("_parts")[position[c]].alias(c) for c in df.columns])


def dealt_text(df: DataFrame, column: str) -> DataFrame:
    """``df`` dealt by the values of ``column``; where all others are text, a row travels as one text."""
    payload = [c for c in df.columns if c != column]
    if any(df.schema[c].dataType != T.StringType() for c in payload):
        return df.repartition(column)
    packed = df.select(column, F.concat(*[_packed(c) for c in payload]).alias("_packed")).repartition(column)
    parts = packed.select(column, _unpacked(F.col("_packed")).alias("_parts"))
    position = {c: i for i, c in enumerate(payload)}
    return parts.select(*[c if c == column else F.col("_parts")[position[c]].alias(c) for c in df.columns])


def _packed(column: str) -> Column:
    """A mark unless null, the text, and an end that is smaller than any character in between."""
    text = F.replace(F.col(column), F.lit("\x01"), F.lit("\x01\x02"))
    text = F.replace(text, F.lit("\x00"), F.lit("\x01\x01"))
    return F.concat(F.coalesce(F.concat(F.lit("\x01"), text), F.lit("")), F.lit("\x00"))


def _unpacked(packed: Column) -> Column:
    """The columns as an array; by one expression for all, which keeps the generated code short."""
    parts = F.transform(F.split(packed, "\\x00"), lambda part: F.when(part != "", F.substr(part, F.lit(2))))
    masked = F.contains(packed, F.lit("\x01\x01")) | F.contains(packed, F.lit("\x01\x02"))
    return F.when(masked, F.transform(parts, _unmasked)).otherwise(parts)


def _unmasked(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\x01\x01"), F.lit("\x00")), F.lit("\x01\x02"), F.lit("\x01"))


def any_by_key(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row per key; which one is up to the physical plan."""
    return df.dropDuplicates([keys] if isinstance(keys, str) else list(keys))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def typed_version(column: str, data_type: str | T.DataType) -> Column:
    """A text version column ranked by value; malformed text ranks as null."""
    return F.col(column).try_cast(data_type)
