"""Bronze text -> typed, cleaned Silver rows, driven by a declared entity."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlode.operators.dedup import any_by_key, latest_by_key, latest_text_by_key, typed_version

KEEP = ("latest", "any", "all")


@dataclass(frozen=True)
class EntitySpec:
    """What is known about one entity.

    ``types``      Silver columns and types in order; also the Bronze text columns.
                   Empty: columns are discovered when landed, and there is no Silver.
    ``key``        natural key.
    ``version``    column that tells newer rows from older ones, if there is one.
    ``watermark``  Bronze column that drives incremental loads, if there is one.
    ``rules``      column -> function(typed column by name) for cleaning and defaults.
    ``tolerant``   columns where text that does not fit the type becomes null.
    ``parent``     for child entities, the column that holds the parent's key.
    ``stamped``    False leaves the Bronze audit column null.
    """

    name: str
    key: str = ""
    types: Mapping[str, str] = field(default_factory=dict)
    version: str | None = None
    watermark: str | None = None
    rules: Mapping[str, Callable[[str], Column]] = field(default_factory=dict)
    tolerant: frozenset[str] = frozenset()
    parent: str | None = None
    stamped: bool = True
    keep: str = "latest"


def typed(df: DataFrame, spec: EntitySpec, row_key: str | None = None) -> DataFrame:
    """The declared columns in their declared types, and ``row_key`` as it is."""
    return df.select(
        *[
            (F.col(c).try_cast(t) if c in spec.tolerant else F.col(c).cast(t)).alias(c)
            for c, t in spec.types.items()
        ],
        *([row_key] if row_key else []),
    )


def cleaned(df: DataFrame, spec: EntitySpec) -> DataFrame:
    return df.select(*[spec.rules.get(c, F.col)(c).alias(c) for c in df.columns])


def newest_rows(bronze: DataFrame, spec: EntitySpec, row_key: str | None = None) -> DataFrame:
    """The newest Bronze row of every key, in the declared columns and still as text.

    ``row_key`` is that of :func:`latest_text_by_key`.
    """
    rows = bronze.select(*spec.types)
    version = typed_version(spec.version, spec.types[spec.version]) if spec.version else None
    text = all(f.dataType == T.StringType() for f in rows.schema.fields)
    if row_key is not None:
        return latest_text_by_key(rows, spec.key, version, row_key)
    return (latest_text_by_key if text else latest_by_key)(rows, spec.key, version)


def conform(
    bronze: DataFrame, spec: EntitySpec, keep: str | None = None, row_key: str | None = None
) -> DataFrame:
    """Bronze -> Silver without audit column: one shuffle, on the key.

    Duplicates go first, while everything is text, so only survivors are cast.
    ``keep`` is ``latest``, ``any`` or ``all``; the default is the spec's. ``row_key``, with
    ``latest``, adds a column that tells the rows apart and that they are partitioned by.
    """
    keep = keep or spec.keep
    if keep not in KEEP:
        raise ValueError(f"keep must be one of {KEEP}, not {keep!r}")
    if row_key is not None and keep != "latest":
        raise ValueError(f"rows kept by {keep!r} have no key of their own")
    rows = bronze.select(*spec.types)
    if keep == "latest":
        rows = newest_rows(rows, spec, row_key)
    elif keep == "any":
        rows = any_by_key(rows, spec.key)
    return cleaned(typed(rows, spec, row_key), spec)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the columns of ``names`` (old -> new), in that order."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])
