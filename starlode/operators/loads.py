"""Tables that grow by whole loads.

The folder of such a table has one folder per load, ``load-00000001`` and so on, with the rows
and, hidden from scans, the files they came from and a record of the load. A load is written
aside and takes its place by one rename that fails if the number is taken. So readers see a load
as a whole or not at all, of two loads at once the later one learns of the other, and a load
that died has added nothing. A replacement starts a new folder, to which the table is switched by
one call of the catalog.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlode.operators import folders
from starlode.operators.load import (
    counted,
    recover,
    switch_location,
    table_location,
    table_property,
)

#: Property of tables that are made of load folders.
LOADS = "starlode.loads"
#: Schema of the files a load has read.
FILES = "path string, size long, modified timestamp"
#: Schema of the keys a load holds: a bitmap for every 32,768 numbers.
KEYS = "bucket long, bits binary"
_FILES, _KEYS, _RECORD = "_files", "_keys", "_load.json"


class Overtaken(Exception):
    """Another load was committed since this one began."""


def file_format(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.sources.default", "parquet")


def _number(name: str) -> int | None:
    head, _, digits = name.partition("-")
    return int(digits) if head == "load" and digits.isdigit() else None


@dataclass(frozen=True)
class Ledger:
    """The committed loads of a table, and what the last of them noted.

    ``watermarks`` by column and ``batches`` by stream are those of all loads so far; ``keyed``
    tells that all of them noted their keys, and that these were whole numbers.
    """

    location: str
    numbers: tuple[int, ...] = ()
    watermarks: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    keyed: bool = True

    @property
    def generation(self) -> str:
        """Name of the folder, which changes when the table is replaced."""
        return self.location.rpartition("/")[2]

    @property
    def ids(self) -> list[str]:
        return [f"{self.generation}/{n}" for n in self.numbers]

    def folder(self, number: int) -> str:
        return f"{self.location}/load-{number:08d}"

    def next(self) -> int:
        return (self.numbers[-1] if self.numbers else 0) + 1

    def files(self, spark: SparkSession) -> DataFrame:
        """The files that the loads have read: path, size, modified."""
        if not self.numbers:
            return spark.createDataFrame([], FILES)
        return spark.read.schema(FILES).parquet(*(f"{self.folder(n)}/{_FILES}" for n in self.numbers))

    def keys(self, spark: SparkSession) -> DataFrame | None:
        """bucket, bits of the keys of all loads; None if not all of them are known."""
        if not self.keyed or not self.numbers:
            return None
        return spark.read.schema(KEYS).parquet(*(f"{self.folder(n)}/{_KEYS}" for n in self.numbers))

    def rows(self, spark: SparkSession, table: str, ids: list[str]) -> DataFrame:
        """The rows of some loads; no other load is listed."""
        schema = spark.read.table(table).schema
        numbers = [n for n, i in zip(self.numbers, self.ids, strict=True) if i in set(ids)]
        if not numbers:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).format(file_format(spark)).load([self.folder(n) for n in numbers])


def ledger(spark: SparkSession, table: str) -> Ledger | None:
    """The loads of ``table``; None if it is not there or not made of loads."""
    recover(spark, table)
    if not spark.catalog.tableExists(table) or table_property(spark, table, LOADS) is None:
        return None
    location = table_location(spark, table)
    numbers = sorted(n for n in map(_number, folders.children(spark, location)) if n is not None)
    last = folders.read_record(spark, f"{location}/load-{numbers[-1]:08d}/{_RECORD}") if numbers else None
    last = last or {}
    return Ledger(
        location, tuple(numbers), last.get("watermarks", {}), last.get("batches", {}), last.get("keyed", False)
    )


@dataclass
class Load:
    """Rows on their way into a table.

    ``files`` are those the rows came from; ``noted`` gives, once the rows are written, what the
    record adds to that of the load before: ``watermarks`` and ``batches``. ``key`` names a column
    whose values are noted, too.
    """

    rows: DataFrame
    files: DataFrame | None = None
    noted: Callable[[], dict[str, dict[str, Any]]] = dict
    bucket_by: tuple[int, str] | None = None
    key: str | None = None


def _note_keys(spark: SparkSession, load: Load, aside: str) -> bool:
    """Write the bitmaps of a load's keys; False if there are none, or some are no whole numbers."""
    if load.key is None:
        return False
    rows = spark.read.schema(load.rows.schema).format(file_format(spark)).load(aside)
    value = F.col(load.key)
    keys = rows.where(value.isNotNull()).select(value.try_cast("long").alias("key"))
    keys, seen = counted(keys, f"keys of {aside}", odd=F.count_if(F.col("key").isNull()))
    found = keys.where(F.col("key").isNotNull()).groupBy(F.bitmap_bucket_number("key").alias("bucket"))
    found.agg(F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits")).write.parquet(f"{aside}/{_KEYS}")
    return not seen.get["odd"]


def uncovered(parents: DataFrame, children: DataFrame) -> int:
    """How many keys of ``parents`` are not among ``children``, both as bucket, bits."""
    both = parents.withColumn("child", F.lit(False)).unionByName(children.withColumn("child", F.lit(True)))
    per_bucket = both.groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"),
        F.bitmap_count(F.bitmap_or_agg(F.when(F.col("child"), F.col("bits")))).alias("covered"),
    )
    return per_bucket.agg(F.coalesce(F.sum(F.col("all") - F.col("covered")), F.lit(0)).alias("n")).first()["n"]


def _stage(spark: SparkSession, load: Load, root: str, before: Ledger) -> tuple[str, int]:
    """Write a load aside; the folder and the number of rows."""
    aside = f"{root}/_{uuid.uuid4().hex}"
    rows, written = counted(load.rows, f"rows of {aside}")
    if load.bucket_by is None:
        rows.write.format(file_format(spark)).save(aside)
    else:
        buckets, column = load.bucket_by
        draft = f"starlode_{uuid.uuid4().hex}"
        writer = rows.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column)
        writer.option("path", aside).saveAsTable(draft)
        spark.sql(f"DROP TABLE {draft}")
    files = load.files if load.files is not None else spark.createDataFrame([], FILES)
    files.write.parquet(f"{aside}/{_FILES}")
    noted, n = load.noted(), written.get["rows"]
    record = {
        "rows": n,
        "watermarks": before.watermarks | noted.get("watermarks", {}),
        "batches": before.batches | noted.get("batches", {}),
        "keyed": _note_keys(spark, load, aside) and before.keyed,
    }
    folders.write_record(spark, f"{aside}/{_RECORD}", record)
    return aside, n


def append_load(spark: SparkSession, table: str, load: Load, before: Ledger) -> int:
    """Commit a load that was planned by ``before``; the number of rows.

    Raises :class:`Overtaken`, with nothing added, if another load took the place since.
    """
    aside, written = _stage(spark, load, before.location, before)
    if table_location(spark, table) != before.location or not folders.move(
        spark, aside, before.folder(before.next())
    ):
        folders.remove(spark, aside)
        raise Overtaken(table)
    spark.catalog.refreshTable(table)
    return written


def replace_loads(spark: SparkSession, table: str, load: Load, root: str) -> int:
    """Make ``table`` anew of one load, in a folder of its own below ``root``.

    What streams have noted stays, so that a repeated batch is known after a replacement as well.
    """
    old = ledger(spark, table)
    location = folders.qualified(spark, f"{root.rstrip('/')}/v-{uuid.uuid4().hex}")
    fresh = Ledger(location, batches=old.batches if old else {})
    aside, written = _stage(spark, load, location, fresh)
    folders.move(spark, aside, fresh.folder(1))
    options = {"recursiveFileLookup": "true"}
    switch_location(spark, table, location, load.rows.schema, load.bucket_by, options, {LOADS: "1"})
    return written
