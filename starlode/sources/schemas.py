"""Schemas of landed envelopes and Bronze tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

from starlode.functions.clock import STAMP


def string_schema(columns: Iterable[str], stamp: bool = True) -> T.StructType:
    """All-string nullable schema in the given order, plus the audit timestamp.

    ``columns`` may be any iterable of names, the keys of a sample record included.
    """
    fields = [T.StructField(name, T.StringType()) for name in columns]
    if stamp:
        fields.append(T.StructField(STAMP, T.TimestampType()))
    return T.StructType(fields)


def envelope_schema(
    columns: Iterable[str] | None = None, carried: Iterable[str] = ()
) -> T.StructType:
    """Schema of one page: ``data`` records, ``meta.hasMore``, ``meta.page`` and carried text fields.

    With ``columns`` the records are structs, so the JSON parser skips every other
    field; without, they are maps and keep all fields.
    """
    record = (
        T.MapType(T.StringType(), T.StringType())
        if columns is None
        else string_schema(columns, stamp=False)
    )
    meta = T.StructType([T.StructField("hasMore", T.BooleanType()), T.StructField("page", T.StringType())])
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in carried]
        + [T.StructField("data", T.ArrayType(record)), T.StructField("meta", meta)]
    )
