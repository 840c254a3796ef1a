"""Landed envelopes, declared schemas and the shared work folder."""

from starlode.sources.landing import (
    OTHER,
    all_fields,
    child_records,
    distinct_parents,
    explode_records,
    landed_files,
    missing_parents,
    new_files,
    page_completeness,
    page_gaps,
    page_of_envelope,
    page_of_file,
    parse_envelopes,
    project_records,
    read_envelopes,
)
from starlode.sources.schemas import envelope_schema, string_schema
from starlode.sources.shared import materialize, shared_path

__all__ = [
    "OTHER",
    "all_fields",
    "child_records",
    "distinct_parents",
    "envelope_schema",
    "explode_records",
    "landed_files",
    "materialize",
    "missing_parents",
    "new_files",
    "page_completeness",
    "page_gaps",
    "page_of_envelope",
    "page_of_file",
    "parse_envelopes",
    "project_records",
    "read_envelopes",
    "shared_path",
    "string_schema",
]
