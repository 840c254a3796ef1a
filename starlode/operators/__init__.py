"""DataFrame -> DataFrame operators and load control."""

from starlode.operators.conform import EntitySpec, conform, rename
from starlode.operators.dedup import any_by_key, distinct_values, latest_by_key
from starlode.operators.guards import fanout_guard, key_collisions, require_unique
from starlode.operators.load import (
    LoadPlan,
    counted,
    newer_than,
    plan_load,
    stamp_load,
    without_stamp,
    write_table,
)
from starlode.operators.star import (
    DecodeSpec,
    DimensionLink,
    DimensionSpec,
    decode_dimension,
    dimension,
    link_dimensions,
)

__all__ = [
    "DecodeSpec",
    "DimensionLink",
    "DimensionSpec",
    "EntitySpec",
    "LoadPlan",
    "any_by_key",
    "conform",
    "counted",
    "decode_dimension",
    "dimension",
    "distinct_values",
    "fanout_guard",
    "key_collisions",
    "latest_by_key",
    "link_dimensions",
    "newer_than",
    "plan_load",
    "rename",
    "require_unique",
    "stamp_load",
    "without_stamp",
    "write_table",
]
