"""Column -> Column helpers; every one stays inside whole-stage codegen."""

from starlode.functions.address import postal_code, state_code, state_or_extracted
from starlode.functions.clock import STAMP, ZONE, load_clock, local_wall_clock
from starlode.functions.decode import (
    PLATFORM_LABELS,
    PLATFORM_UNKNOWN,
    STATUS_LABELS,
    STATUS_UNKNOWN,
    deletion_label,
    label_of,
    platform_label,
    status_label,
    yes_no,
)
from starlode.functions.keys import surrogate_key
from starlode.functions.text import (
    blank_to,
    digits_only,
    empty_list_to,
    empty_to,
    empty_to_upper,
    null_to_upper,
    trim_lower,
    trim_upper,
    zero_fill,
)

__all__ = [
    "PLATFORM_LABELS",
    "PLATFORM_UNKNOWN",
    "STAMP",
    "STATUS_LABELS",
    "STATUS_UNKNOWN",
    "ZONE",
    "blank_to",
    "deletion_label",
    "digits_only",
    "empty_list_to",
    "empty_to",
    "empty_to_upper",
    "label_of",
    "load_clock",
    "local_wall_clock",
    "null_to_upper",
    "platform_label",
    "postal_code",
    "state_code",
    "state_or_extracted",
    "status_label",
    "surrogate_key",
    "trim_lower",
    "trim_upper",
    "yes_no",
    "zero_fill",
]
