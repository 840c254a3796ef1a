"""Landed pages -> Bronze as an available-now stream.

The checkpoint remembers which files were read, so a run touches only new ones. Batches are
committed like the loads of ``run_bronze``, with the files they read and their own number, so one
that is repeated after a crash adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starlode.operators.conform import EntitySpec
from starlode.operators.load import FULL, INCREMENTAL, LoadPlan
from starlode.operators.loads import Overtaken, ledger
from starlode.plans.entities import ENTITIES
from starlode.plans.jobs import (
    ATTEMPTS,
    CORRUPT,
    FILE,
    PAGE_FILE,
    bronze_envelopes,
    bronze_rows,
    load_envelopes,
    stamped_bronze,
)
from starlode.plans.lakehouse import Lakehouse, LoadReport
from starlode.sources.landing import landed_files, read_envelopes


def _plain(path: str) -> Column:
    """A file's address as listings have it: letters in place of their codes."""
    letters = F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(letters, "^file:/+", "file:/")


def run_bronze_new_files(
    spark: SparkSession,
    lake: Lakehouse,
    entity: str,
    landing: str,
    state: str,
    *,
    file_per_envelope: bool = False,
    parent_pattern: str | None = None,
    check_parents: bool = True,
    quarantine: bool = False,
    page_pattern: str = PAGE_FILE,
) -> LoadReport:
    """Append the records of files no earlier run has read, whatever their watermark.

    ``state`` is a folder that remembers the files. Options and report are those of
    ``run_bronze``; the report adds up the batches. A batch that was written before its run died
    is known by its number, which is noted with its rows, and is not written again.
    """
    spec, table = ENTITIES[entity], lake.table("bronze", entity)
    corrupt = CORRUPT if quarantine else None
    reports: list[LoadReport] = []

    def append(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        read = batch.select(_plain(FILE).alias("path")).distinct()
        for _ in range(ATTEMPTS):
            before = ledger(own, table)
            if before is not None and number <= before.batches.get(state, -1):
                return
            there = before is not None or own.catalog.tableExists(table)
            try:
                reports.append(
                    load_envelopes(
                        own,
                        lake,
                        entity,
                        batch,
                        LoadPlan(INCREMENTAL if there else FULL),
                        before,
                        landed_files(own, landing).join(read, "path", "left_semi"),
                        check_parents=check_parents,
                        quarantine=quarantine,
                        page_pattern=page_pattern,
                        by_watermark=False,
                        batch=(state, number),
                    )
                )
                return
            except Overtaken:
                continue
        raise Overtaken(table)

    pages = bronze_envelopes(
        spark, spec, landing, None, file_per_envelope, parent_pattern, corrupt, stream=True
    )
    stream = pages.writeStream.foreachBatch(append).option("checkpointLocation", state)
    try:
        stream.trigger(availableNow=True).start().awaitTermination()
    finally:  # batches run in a session of their own
        if spark.catalog.tableExists(table):
            spark.catalog.refreshTable(table)
    return _summed(table, reports)


def _summed(table: str, reports: list[LoadReport]) -> LoadReport:
    if not reports:
        return LoadReport(table, None)

    def total(name: str) -> int | None:
        found = [n for r in reports if (n := getattr(r, name)) is not None]
        return sum(found) if found else None

    last = reports[-1]
    return LoadReport(
        table,
        INCREMENTAL,
        sum(r.rows for r in reports),
        complete=any(r.complete for r in reports),
        undated=total("undated"),
        null_records=total("null_records"),
        missing_parents=last.missing_parents,
        files=total("files"),
        missing_pages=last.missing_pages,
        rejected=total("rejected"),
    )


def stream_bronze(
    spark: SparkSession,
    spec: EntitySpec,
    landing: str,
    checkpoint: str,
    *,
    table: str | None = None,
    path: str | None = None,
    files_per_batch: int | None = None,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Append the records of new files to ``table`` or to Parquet files under ``path``.

    The default trigger drains what has landed and stops.
    """
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    pages = read_envelopes(
        spark,
        landing,
        carried=[spec.parent] if spec.parent else [],
        stream=True,
        files_per_batch=files_per_batch,
    )
    rows = stamped_bronze(bronze_rows(pages, spec), spec)
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return writer.toTable(table) if table is not None else writer.start(path)
