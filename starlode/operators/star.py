"""Dimensions and facts.

No join carries a broadcast hint. Dimensions are read back from tables, so Catalyst
knows their size: below ``spark.sql.autoBroadcastJoinThreshold`` they are broadcast,
above it the join shuffles and AQE splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlode.functions.keys import surrogate_key
from starlode.operators.dedup import distinct_values, latest_by_key


@dataclass(frozen=True)
class DecodeSpec:
    """A dimension made of the distinct codes of one column and their labels."""

    name: str
    source: str
    code: str
    surrogate: str
    natural: str
    label: str
    labelled: Callable[[str], Column]


@dataclass(frozen=True)
class DimensionSpec:
    """A current-state dimension.

    ``names``   Silver columns and their published names, the natural key first.
    ``labels``  further published columns, made by a function.
    ``order``   published order, if labels stand between the names.
    ``newest``  False trusts Silver to hold one row per key and saves a shuffle.
    """

    name: str
    source: str
    key: str
    surrogate: str
    names: Mapping[str, str]
    labels: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    order: Sequence[str] = ()
    version: str | None = None
    newest: bool = True


@dataclass(frozen=True)
class DimensionLink:
    """How a fact finds the surrogate key of a dimension."""

    dimension: str
    foreign: str
    natural: str
    surrogate: str
    null_safe: bool = False


def decode_dimension(df: DataFrame, spec: DecodeSpec, method: str = "crc32") -> DataFrame:
    """One row per code, null included (null key, unknown label)."""
    return distinct_values(df, spec.code).select(
        surrogate_key(spec.code, method).alias(spec.surrogate),
        F.col(spec.code).alias(spec.natural),
        spec.labelled(spec.code).alias(spec.label),
    )


def dimension(
    df: DataFrame,
    spec: DimensionSpec,
    method: str = "crc32",
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Newest row per key (or all rows) -> surrogate key and published columns.

    ``enrich`` joins other tables to the newest rows, ``where`` leaves rows out; both
    act after the choice of the newest row, so a key may vanish as a whole.
    """
    rows = latest_by_key(df, spec.key, spec.version) if spec.newest else df
    if where is not None:
        rows = rows.filter(where)
    if enrich is not None:
        rows = enrich(rows)
    published = {new: F.col(old) for old, new in spec.names.items()}
    published |= {new: make() for new, make in spec.labels.items()}
    return rows.select(
        surrogate_key(spec.key, method).alias(spec.surrogate),
        *[published[c].alias(c) for c in (spec.order or published)],
    )


def link_dimensions(
    fact: DataFrame,
    links: Sequence[DimensionLink],
    dims: Mapping[str, DataFrame],
    row_key: str | None = None,
) -> DataFrame:
    """Left equi-joins that add one surrogate key per link, null without a match.

    Only key and surrogate of a dimension enter the join. ``row_key`` names a column of ``fact``
    that is never null and has no value twice: then only it and the foreign keys go through the
    links, and the surrogates come back by it. Where the fact is partitioned by it already, no
    whole row is shuffled, however many links are too large to be broadcast.
    """
    if row_key is not None:
        narrow = fact.select(row_key, *dict.fromkeys(link.foreign for link in links))
        found = link_dimensions(narrow, links, dims).select(row_key, *[link.surrogate for link in links])
        return fact.join(found, row_key)
    for link in links:
        keys = dims[link.dimension].select(F.col(link.natural).alias("_natural"), link.surrogate)
        same = (
            fact[link.foreign].eqNullSafe(keys["_natural"])
            if link.null_safe
            else fact[link.foreign] == keys["_natural"]
        )
        fact = fact.join(keys, same, "left").drop("_natural")
    return fact
