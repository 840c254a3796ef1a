"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlode.functions.text import _col


def surrogate_key(natural_key: Column | str, method: str = "crc32") -> Column:
    """64-bit key hashed from the text of the natural key; null stays null.

    ``crc32`` is the published contract, but it spans only 2**32 values: collisions
    are likely from about 77,000 keys on (``operators.guards.key_collisions`` lists
    them). ``xxhash64`` spans 2**64 and suits large dimensions.
    """
    text = _col(natural_key).cast("string")
    if method == "crc32":
        return F.crc32(text)
    if method == "xxhash64":
        return F.when(text.isNotNull(), F.xxhash64(text))
    raise ValueError(f"unknown surrogate key method: {method!r}")
