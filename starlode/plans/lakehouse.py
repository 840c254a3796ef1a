"""Where the tables of each layer live."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Lakehouse:
    """Databases of the three layers, a common table prefix and optional table layout.

    ``location``  folder for external tables; None leaves the place to the catalog.
    ``buckets``   table name -> (number of buckets, column), see ``write_table``.
    """

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    prefix: str = ""
    location: str | None = None
    buckets: Mapping[str, tuple[int, str]] = field(default_factory=dict)

    def table(self, layer: str, name: str) -> str:
        return f"{getattr(self, layer)}.{self.prefix}{name}"

    def path(self, layer: str, name: str) -> str | None:
        if self.location is None:
            return None
        return f"{self.location.rstrip('/')}/{getattr(self, layer)}/{self.prefix}{name}"

    def home(self, spark: SparkSession, layer: str, name: str) -> str:
        """The folder below which folders of rows are made; beside the database without a location."""
        path = self.path(layer, name)
        if path is not None:
            return path
        rows = spark.sql(f"DESCRIBE DATABASE {getattr(self, layer)}").collect()
        place = {r[0]: r[1] for r in rows}["Location"]
        return f"{place.rstrip('/')}/{self.prefix}{name}-folders"

    def create_databases(self, spark: SparkSession) -> None:
        for database in (self.bronze, self.silver, self.gold):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


@dataclass(frozen=True)
class LoadReport:
    """What a load did.

    ``mode``         FULL or INCREMENTAL; None if nothing was landed and so nothing written.
    ``rows``         rows written.
    ``source_rows``  rows of the table that was read (Silver and Gold).
    ``complete``     whether a last page was among the landed ones (Bronze).
    ``undated``      rows written without a watermark value (Bronze entities that have one).
    ``null_records`` elements of pages that were null and left out (Bronze).
    ``missing_parents``  parents in Bronze without a child there (child entities).
    ``duplicate_keys``   natural keys that occur more than once (Gold).
    ``key_collisions``   surrogate keys that several natural keys share (Gold).
    ``files``            landed files that this load has read (Bronze).
    ``missing_pages``    page numbers that the landed sets lack; None without numbered files (Bronze).
    ``rejected``         malformed pages put aside; None where such a page ends the load (Bronze).
    """

    table: str
    mode: str | None
    rows: int = 0
    source_rows: int | None = None
    complete: bool | None = None
    undated: int | None = None
    null_records: int | None = None
    missing_parents: int | None = None
    duplicate_keys: int | None = None
    key_collisions: int | None = None
    files: int | None = None
    missing_pages: int | None = None
    rejected: int | None = None
