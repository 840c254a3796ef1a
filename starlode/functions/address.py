"""State and postal code out of a free-text address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlode.functions.text import _col, digits_only

# The 27 federal unit codes, in the order they are tried.
STATE_CODES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)
# The postal code mark and the width of a postal code.
POSTAL_MARK = "CEP"
POSTAL_WIDTH = 8


def state_code(address: Column | str) -> Column:
    """First state code standing as a word of its own.

    Case-sensitive; ``''`` without a match, null for a null address.
    """
    return F.regexp_extract(_col(address), rf"\b({'|'.join(STATE_CODES)})\b", 1)


def state_or_extracted(state: Column | str, address: Column | str) -> Column:
    """The given state, else the one found in the address (``''`` if there is none)."""
    return F.coalesce(_col(state), state_code(address))


def postal_code(address: Column | str, source: Column | str | None = None) -> Column:
    """Digits after the first mark up to the end of its line, eight wide.

    Shorter ones are padded with zeros on the left (``'00000000'`` without a mark),
    longer ones keep their first eight digits. ``source`` takes a postal code
    delivered apart from the address and prefers its digits where it has any.
    """
    found = digits_only(F.regexp_extract(_col(address), rf"{POSTAL_MARK}(.*)", 1))
    if source is not None:
        found = F.coalesce(F.nullif(digits_only(source), F.lit("")), found)
    return F.lpad(found, POSTAL_WIDTH, "0")
