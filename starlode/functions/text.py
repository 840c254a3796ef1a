"""Text normalisation and defaults.

The three default rules differ on purpose and must not be merged:

=================  ======  ======  ========
rule               null    ``''``  ``'  '``
=================  ======  ======  ========
``null_to_upper``  d       ``''``  ``''``
``blank_to``       null    d       d
``empty_to``       d       d       kept
=================  ======  ======  ========
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_upper(c: Column | str) -> Column:
    """Upper case without leading and trailing blanks (tabs stay)."""
    return F.trim(F.upper(_col(c)))


def trim_lower(c: Column | str) -> Column:
    return F.trim(F.lower(_col(c)))


def null_to_upper(c: Column | str, default: str) -> Column:
    return trim_upper(F.coalesce(_col(c), F.lit(default)))


def blank_to(c: Column | str, default: str) -> Column:
    clean = trim_upper(c)
    return F.when(clean == "", F.lit(default)).otherwise(clean)


def empty_to(c: Column | str, default: str) -> Column:
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(default))


def empty_to_upper(c: Column | str, default: str) -> Column:
    """``empty_to`` followed by ``trim_upper``; a blank text becomes ``''``."""
    return trim_upper(empty_to(c, default))


def empty_list_to(c: Column | str, default: str) -> Column:
    """Default for a list kept as text: ``'[]'``, ``''`` and null."""
    c = _col(c)
    return F.when(c.isNull() | c.isin("[]", ""), F.lit(default)).otherwise(c)


def zero_fill(c: Column | str) -> Column:
    """Null number -> 0. A ``decimal(10,2)`` widens to ``decimal(12,2)``."""
    return F.coalesce(_col(c), F.lit(0))


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "[^0-9]", "")
