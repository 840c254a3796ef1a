"""Audit clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlode.functions.text import _col

# Name of the audit column and the zone its wall clock shows.
STAMP = "DT_HR_CARGA"
ZONE = "America/Sao_Paulo"


def local_wall_clock(instant: Column | str, zone: str = ZONE) -> Column:
    """Shift a UTC instant to the wall clock of ``zone``; the result is no instant."""
    return F.from_utc_timestamp(_col(instant), zone)


def load_clock(zone: str = ZONE) -> Column:
    """Time of the load, one value per query."""
    return local_wall_clock(F.current_timestamp(), zone)
