"""Load control, audit stamp and table sink."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starlode.functions.clock import STAMP, ZONE, load_clock
from starlode.operators import folders

FULL = "FULL"
INCREMENTAL = "INCREMENTAL"
#: Formats whose tables are plain folders of files, which can be switched as a whole.
FOLDER_FORMATS = ("parquet", "orc")


@dataclass(frozen=True)
class LoadPlan:
    """FULL (overwrite) or INCREMENTAL (append what is newer than ``watermark``)."""

    mode: str
    watermark: Any = None

    @property
    def incremental(self) -> bool:
        return self.mode == INCREMENTAL


def high_watermark(df: DataFrame, column: str, data_type: str | None = None) -> Any:
    """Largest value of ``column``, by text or by ``data_type``. One row reaches the driver."""
    return df.agg(highest(column, data_type).alias("high")).first()["high"]


def highest(column: str, data_type: str | None = None) -> Column:
    """The value that is largest; text that does not fit ``data_type`` never is."""
    value = F.col(column)
    return F.max(value) if data_type is None else F.max_by(value, value.try_cast(data_type))


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    """A property stored with a table; None for views and for tables without it."""
    try:
        found = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == key).first()
    except AnalysisException:
        return None
    return found["value"] if found else None


def set_table_properties(spark: SparkSession, table: str, values: dict[str, Any]) -> None:
    listed = ", ".join("'{}' = '{}'".format(k, str(v).replace("'", r"\'")) for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a table's files."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").collect()
    return rows[-1]["data_type"].rstrip("/")


def watermark_key(column: str) -> str:
    return f"starlode.watermark.{column}"


def plan_load(
    spark: SparkSession,
    table: str,
    column: str | None = None,
    force_full: bool = False,
    data_type: str | None = None,
) -> LoadPlan:
    """Incremental only if the table exists and its watermark column holds a value.

    The watermark is stored with the table by the load that wrote it; the column is scanned
    only where that is missing.
    """
    if force_full or not column or not spark.catalog.tableExists(table):
        return LoadPlan(FULL)
    high = table_property(spark, table, watermark_key(column))
    if high is None:
        high = high_watermark(spark.read.table(table), column, data_type)
    return LoadPlan(FULL) if high is None else LoadPlan(INCREMENTAL, high)


def newer_than(
    df: DataFrame,
    column: str,
    watermark: Any,
    inclusive: bool = False,
    data_type: str | None = None,
) -> DataFrame:
    """Rows past the watermark, and those of which nobody can tell: without a value.

    ``data_type`` compares by that type, for text whose order differs; what does not fit it
    counts as no value. ``inclusive`` also takes rows of equal age, which arrive late without
    being newer; the Silver dedup removes what was loaded before.
    """
    value, limit = F.col(column), F.lit(watermark)
    if data_type is not None:
        value, limit = value.try_cast(data_type), limit.try_cast(data_type)
    return df.filter((value >= limit if inclusive else value > limit) | value.isNull())


def stamp_load(df: DataFrame, zone: str = ZONE) -> DataFrame:
    return df.withColumn(STAMP, load_clock(zone))


def without_stamp(df: DataFrame) -> DataFrame:
    return df.drop(STAMP)


def counted(df: DataFrame, name: str, **metrics: Any) -> tuple[DataFrame, Observation]:
    """Count the rows while the next action runs: no second scan.

    Read ``observation.get["rows"]`` after the action. A retried stage *below* a
    shuffle may count twice, so observe the frame that is written.
    """
    observation = Observation(name)
    columns = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in metrics.items()]
    return df.observe(observation, *columns), observation


def write_table(
    df: DataFrame,
    table: str,
    mode: str = FULL,
    *,
    path: str | None = None,
    bucket_by: tuple[int, str] | None = None,
) -> int:
    """Save as a catalog table: FULL replaces, everything else appends by name.

    Returns the number of rows, counted by the tasks that write them. A replacement is written to
    a folder of its own, and the table is switched to it by one call of the catalog once it is
    complete, so a reader finds the old rows or the new ones, and a write that fails leaves the
    old ones. With ``path`` these folders lie below it. Formats that replace tables by themselves
    are left to do so.

    ``bucket_by`` (buckets, column) lets a later join on that column skip its shuffle.
    Rows are brought to their bucket first, so every bucket is one file and not one
    per task. Leave it out where one key holds much of the table, since a bucket is
    never split. An append must repeat the bucketing of the table.
    """
    spark = df.sparkSession
    recover(spark, table)
    if bucket_by is not None:
        df = df.repartition(*bucket_by)
    df, written = counted(df, f"rows of {table}")
    there = spark.catalog.tableExists(table)
    form = spark.conf.get("spark.sql.sources.default", "parquet")
    if there and mode == FULL and form in FOLDER_FORMATS:
        old = table_location(spark, table)
        new = f"{path.rstrip('/') if path else old.rpartition('/')[0]}/{_folder(table, path)}"
        writer = df.write.format(form)
        if bucket_by is None:
            writer.save(new)
        else:
            draft = f"starlode_{uuid.uuid4().hex}"
            writer.bucketBy(*bucket_by).sortBy(bucket_by[1]).option("path", new).saveAsTable(draft)
            spark.sql(f"DROP TABLE {draft}")
        switch_location(spark, table, new, df.schema, bucket_by)
        return written.get["rows"]
    writer = df.write.mode("overwrite" if mode == FULL else "append")
    if path is not None and not there:
        writer = writer.option("path", f"{path.rstrip('/')}/{_folder(table, path)}")
    if bucket_by is not None:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(table)
    return written.get["rows"]


def _folder(table: str, path: str | None) -> str:
    """A name for a folder of rows; beside other tables it begins with the table's own."""
    name = f"v-{uuid.uuid4().hex}"
    return name if path else f"{table.rpartition('.')[2]}-{name}"


def _layout(spark: SparkSession, table: str) -> tuple[str | None, str | None]:
    """(buckets, column) of a table, as the catalog shows them."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    return rows.get("Num Buckets"), rows.get("Bucket Columns")


def switch_location(
    spark: SparkSession,
    table: str,
    location: str,
    schema: StructType,
    bucket_by: tuple[int, str] | None = None,
    options: dict[str, str] | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Let ``table`` be the files at ``location``, then remove the folder it had.

    A table of the same columns moves by one call. Another one is created as ``<table>__next``,
    complete, and takes the name; should that stop between its two calls, :func:`recover` ends it.
    """
    there = spark.catalog.tableExists(table)
    known = {f.name: f.dataType for f in schema.fields}
    wanted = (str(bucket_by[0]), f"[`{bucket_by[1]}`]") if bucket_by else (None, None)
    same = (
        there
        and {f.name: f.dataType for f in spark.read.table(table).schema.fields} == known
        and _layout(spark, table) == wanted
        and all(table_property(spark, table, k) == v for k, v in (properties or {}).items())
    )
    old = own_folder(spark, table) if there else None
    if same:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(location)}'")
    else:
        target = f"{table}__next" if there else table
        spark.sql(f"DROP TABLE IF EXISTS {table}__next")
        _create(spark, target, location, schema, bucket_by, options, properties)
        if there:
            spark.sql(f"DROP TABLE {table}")
            spark.sql(f"ALTER TABLE {target} RENAME TO {table}")
    spark.catalog.refreshTable(table)
    if old is not None:
        new, inner = folders.qualified(spark, location), f"{folders.qualified(spark, old)}/"
        if not new.startswith(inner):
            folders.remove(spark, old)
        else:  # the new folder lies in the old one
            for name in folders.children(spark, old):
                if name != new.removeprefix(inner).split("/")[0]:
                    folders.remove(spark, f"{old}/{name}")


def own_folder(spark: SparkSession, table: str) -> str | None:
    """The folder of a table, unless somebody else may own it: an external one not made here."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    location = rows["Location"].rstrip("/")
    made_here = "v-" in location.rpartition("/")[2] or "starlode" in rows.get("Table Properties", "")
    return location if rows.get("Type") == "MANAGED" or made_here else None


def _quoted(text: str) -> str:
    return text.replace("\\", r"\\").replace("'", r"\'")


def _create(
    spark: SparkSession,
    table: str,
    location: str,
    schema: StructType,
    bucket_by: tuple[int, str] | None,
    options: dict[str, str] | None,
    properties: dict[str, str] | None,
) -> None:
    form = spark.conf.get("spark.sql.sources.default", "parquet")
    ddl = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json()).toDDL()
    parts = [f"CREATE TABLE {table} ({ddl}) USING {form}"]
    for word, values in (("OPTIONS", options), ("TBLPROPERTIES", properties)):
        if values:
            parts.append(f"{word} ({', '.join(f"'{k}' = '{_quoted(v)}'" for k, v in values.items())})")
    if bucket_by is not None:
        parts.insert(1, f"CLUSTERED BY (`{bucket_by[1]}`) SORTED BY (`{bucket_by[1]}`) INTO {bucket_by[0]} BUCKETS")
    spark.sql(" ".join([*parts, f"LOCATION '{_quoted(location)}'"]))


def recover(spark: SparkSession, table: str) -> None:
    """End a replacement that stopped between its two calls: the new table takes the name."""
    following = f"{table}__next"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(following):
        spark.sql(f"ALTER TABLE {following} RENAME TO {table}")


def open_table(spark: SparkSession, table: str) -> DataFrame:
    """A table to read, after :func:`recover`."""
    recover(spark, table)
    return spark.read.table(table)
