"""Tables in buckets of keys, each bucket in a folder of its own, that change by whole buckets.

Several stores that change together share one record, a numbered small file beside the first of
them: the folder of every bucket, and how far the source was read. A change writes the buckets it
touches into new folders, then the next record. That is the commit; it fails if the number is
taken. The partitions of the tables follow the record, by calls that may be repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starlode.operators import folders
from starlode.operators.load import own_folder, recover, set_table_properties, table_property
from starlode.operators.loads import Overtaken, file_format

#: Property of a table: the number of the record that its partitions follow.
FOLLOWS = "starlode.record"
_RECORDS = "_records"
_KEPT = 8  # records that stay for whoever wants to look back


@dataclass(frozen=True)
class BucketStore:
    """A partitioned table and the folder below which its buckets lie."""

    table: str
    root: str

    def folder(self, generation: str, column: str, bucket: int) -> str:
        return f"{self.root.rstrip('/')}/{generation}/{column}={bucket}"

    def rows(self, spark: SparkSession, state: BucketState, buckets: Sequence[int], schema: StructType) -> DataFrame:
        """The rows of some buckets, without a look at any other; ``schema`` has no bucket."""
        found = state.folders[self.table]
        paths = [self.folder(found[b], state.column, b) for b in buckets if b in found]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).format(file_format(spark)).load(paths)


@dataclass(frozen=True)
class BucketState:
    """A record: which folders make up the stores, and what of the source they hold.

    ``folders`` names the generation of every bucket that has rows, by table; ``touched`` are
    the buckets that this record changed.
    """

    number: int
    source: str
    until: int
    buckets: int
    column: str
    touched: list[int]
    folders: dict[str, dict[int, str]]

    def as_json(self) -> dict:
        return {k: getattr(self, k) for k in ("source", "until", "buckets", "column", "touched", "folders")}


def _read(spark: SparkSession, store: BucketStore, number: int) -> BucketState | None:
    found = folders.read_record(spark, f"{store.root}/{_RECORDS}/{number:08d}.json")
    if found is None:
        return None
    by_table = {t: {int(b): g for b, g in own.items()} for t, own in found["folders"].items()}
    return BucketState(number=number, **found | {"folders": by_table})


def _numbers(spark: SparkSession, store: BucketStore) -> list[int]:
    names = folders.children(spark, f"{store.root}/{_RECORDS}")
    return [int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()]


def current_state(spark: SparkSession, stores: Sequence[BucketStore]) -> BucketState | None:
    """The last record, after the tables were made to follow it; None if there is none to go by.

    Tables that something else has replaced since have no mark, and the record counts no more.
    """
    numbers = _numbers(spark, stores[0])
    if not numbers:
        return None
    for store in stores:
        recover(spark, store.table)
        if not spark.catalog.tableExists(store.table) or table_property(spark, store.table, FOLLOWS) is None:
            return None
    state = _read(spark, stores[0], numbers[-1])
    if state is not None:
        follow(spark, stores, state)
    return state


def latest_generation(state: BucketState, store: BucketStore) -> str:
    """Name of the newest folder of a store, which no other state has as its newest."""
    return max(state.folders[store.table].values(), default="")


def touched_since(
    spark: SparkSession, stores: Sequence[BucketStore], number: int, generation: str
) -> list[int] | None:
    """Buckets that records after ``number`` have touched.

    None if that cannot be told: a record is gone, or is not the one that had ``generation`` as
    its newest folder.
    """
    numbers = _numbers(spark, stores[0])
    wanted = [n for n in numbers if n >= number]
    if not wanted or wanted != list(range(number, numbers[-1] + 1)):
        return None
    first, *later = (_read(spark, stores[0], n) for n in wanted)
    if latest_generation(first, stores[0]) != generation:
        return None
    return sorted({b for state in later for b in state.touched})


def lost_buckets(spark: SparkSession, stores: Sequence[BucketStore], state: BucketState) -> list[int]:
    """Buckets of which a folder that the record names is gone or empty."""
    lost: set[int] = set()
    for store in stores:
        for bucket, generation in state.folders[store.table].items():
            names = folders.children(spark, store.folder(generation, state.column, bucket))
            if not any(not n.startswith(("_", ".")) for n in names):
                lost.add(bucket)
    return sorted(lost)


def commit_buckets(
    spark: SparkSession,
    stores: Sequence[BucketStore],
    rows: Sequence[DataFrame],
    before: BucketState | None,
    touched: Sequence[int],
    column: str,
    buckets: int,
    source: str,
    until: int,
    dealt: bool = False,
) -> BucketState:
    """Write the ``touched`` buckets of each store, commit the record, and let the tables follow.

    ``rows`` has one frame per store, with the bucket in ``column``. ``dealt`` says that buckets
    are not spread over partitions: they are written without a shuffle. Raises
    :class:`Overtaken` if another change was committed since ``before``.
    """
    taken = _numbers(spark, stores[0])
    number = (before.number if before else max(taken, default=0)) + 1
    generation = f"g-{number:08d}-{uuid.uuid4().hex[:8]}"
    known: dict[str, dict[int, str]] = {}
    for store, df in zip(stores, rows, strict=True):
        place = f"{store.root.rstrip('/')}/{generation}"
        # a bucket is one file, or a few where a large one was dealt before and is read in splits
        (df if dealt else df.repartition(column)).write.format(file_format(spark)).partitionBy(column).save(place)
        made = {n.partition("=")[2] for n in folders.children(spark, place) if n.startswith(f"{column}=")}
        old = before.folders[store.table] if before else {}
        known[store.table] = {b: g for b, g in old.items() if b not in set(touched)}
        known[store.table] |= {int(b): generation for b in made}
    state = BucketState(number, source, until, buckets, column, list(touched), known)
    if not folders.write_record(spark, f"{stores[0].root}/{_RECORDS}/{number:08d}.json", state.as_json()):
        for store in stores:
            folders.remove(spark, f"{store.root.rstrip('/')}/{generation}")
        raise Overtaken(stores[0].table)
    follow(spark, stores, state, [df.schema for df in rows])
    return state


def follow(
    spark: SparkSession, stores: Sequence[BucketStore], state: BucketState, schemas: Sequence[StructType] | None = None
) -> None:
    """Point the partitions of the tables to the folders of the record, then drop old folders."""
    behind = [s for s in stores if table_property_or_none(spark, s.table) != str(state.number)]
    for store in behind:
        own = state.folders[store.table]
        if table_property_or_none(spark, store.table) is None:
            if schemas is None:
                raise ValueError(f"{store.table} is not there")
            _create(spark, store, schemas[stores.index(store)], state)
        else:
            there = {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {store.table}").collect()}
            gone = {int(b) for b in there} - own.keys()
            for bucket in sorted(gone.union(state.touched)):
                part, place = f"PARTITION ({state.column}={bucket})", store.folder(own.get(bucket, ""), state.column, bucket)
                if bucket not in own:
                    spark.sql(f"ALTER TABLE {store.table} DROP IF EXISTS {part}")
                elif str(bucket) in there:
                    spark.sql(f"ALTER TABLE {store.table} {part} SET LOCATION '{place}'")
                else:
                    spark.sql(f"ALTER TABLE {store.table} ADD IF NOT EXISTS {part} LOCATION '{place}'")
        set_table_properties(spark, store.table, {FOLLOWS: state.number})
        spark.catalog.refreshTable(store.table)
    if behind:
        _drop_old(spark, stores, state)


def table_property_or_none(spark: SparkSession, table: str) -> str | None:
    return table_property(spark, table, FOLLOWS) if spark.catalog.tableExists(table) else None


def _create(spark: SparkSession, store: BucketStore, schema: StructType, state: BucketState) -> None:
    """A table over the folders of the record; it takes the name once it is complete."""
    old = own_folder(spark, store.table) if spark.catalog.tableExists(store.table) else None
    target = f"{store.table}__next"
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    ddl = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json()).toDDL()
    spark.sql(
        f"CREATE TABLE {target} ({ddl}) USING {file_format(spark)} PARTITIONED BY ({state.column}) "
        f"LOCATION '{store.root}' TBLPROPERTIES ('{FOLLOWS}' = '{state.number}')"
    )
    parts = [
        f"PARTITION ({state.column}={b}) LOCATION '{store.folder(g, state.column, b)}'"
        for b, g in state.folders[store.table].items()
    ]
    if parts:
        spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS {' '.join(parts)}")
    spark.sql(f"DROP TABLE IF EXISTS {store.table}")
    spark.sql(f"ALTER TABLE {target} RENAME TO {store.table}")
    if old is not None and not folders.qualified(spark, store.root).startswith(folders.qualified(spark, old)):
        folders.remove(spark, old)


def _drop_old(spark: SparkSession, stores: Sequence[BucketStore], state: BucketState) -> None:
    """Remove the folders that the record before named and this one does not, and old records."""
    previous = _read(spark, stores[0], state.number - 1)
    for store in stores:
        own, old = state.folders[store.table], previous.folders.get(store.table, {}) if previous else {}
        for bucket, generation in old.items():
            if own.get(bucket) != generation:
                folders.remove(spark, store.folder(generation, state.column, bucket))
        for generation in set(old.values()) - set(own.values()):
            folders.remove(spark, f"{store.root.rstrip('/')}/{generation}")
    for number in _numbers(spark, stores[0])[:-_KEPT]:
        folders.remove(spark, f"{stores[0].root}/{_RECORDS}/{number:08d}.json")
