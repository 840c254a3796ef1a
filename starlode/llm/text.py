"""Words, letters and names shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII whitespace, and words by the two contracts in use.
SPACE = r"\x20\x09-\x0D"
SPACED_WORD = rf"[^{SPACE}]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def words_of(text: Column, pattern: str = SPACED_WORD) -> Column:
    """All matches of ``pattern``; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; texts of ASCII alone take the quick way."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
