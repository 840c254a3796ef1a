"""Scans of landed pages.

A page is an envelope ``{"data": [record, ...], "meta": {"hasMore": bool}}``. The
pages of an entity are a bag of envelopes spread over many files, so they are read
and exploded in parallel; no record passes through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from starlode.sources.schemas import envelope_schema

#: Column of Bronze tables with the landed fields that no column is declared for.
OTHER = "other_fields"


def read_envelopes(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str] | None = None,
    *,
    carried: Sequence[str] = (),
    file_per_envelope: bool = False,
    parent: str | None = None,
    parent_pattern: str | None = None,
    corrupt: str | None = None,
    base: str | None = None,
    stream: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Envelopes under ``path``; a malformed one fails the job.

    By default each line holds one envelope: large files that Spark splits.
    ``file_per_envelope`` reads one (possibly pretty-printed) envelope per file.
    A nested value becomes its JSON text, with the blanks it landed with.
    ``parent_pattern`` takes the column ``parent`` from the file path, first group.
    ``corrupt`` names a column that takes the text of malformed envelopes, which then fail
    nothing. ``base`` is the folder that was landed, where ``path`` lists single files of it.
    ``stream`` reads as a stream, ``files_per_batch`` of its files at a time.
    """
    schema = envelope_schema(columns, carried)
    reader = (spark.readStream if stream else spark.read).option("multiLine", file_per_envelope)
    if corrupt is None:
        reader = reader.option("mode", "FAILFAST")
    else:
        schema = schema.add(corrupt, T.StringType())
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    if base is not None:
        reader = reader.option("basePath", base)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    envelopes = reader.schema(schema).json(path)
    if parent_pattern is not None:
        if parent is None:
            raise ValueError("parent_pattern needs the name of the parent column")
        envelopes = envelopes.withColumn(
            parent, F.regexp_extract(F.col("_metadata.file_path"), parent_pattern, 1)
        )
    return envelopes


def landed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, size, modified of the files under ``path``; none is opened."""
    listed = spark.read.format("binaryFile").load(path)
    return listed.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def new_files(landed: DataFrame, seen: DataFrame) -> DataFrame:
    """Landed files that no load has seen; one that was written anew counts as another."""
    return landed.join(seen, ["path", "size", "modified"], "left_anti")


def literal_path(path: str) -> str:
    """A path whose letters stand for themselves, where globs are read as well."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def parse_envelopes(
    payloads: DataFrame, payload: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """Envelopes landed as a text column; the other columns are kept."""
    parsed = F.from_json(payload, envelope_schema(columns), {"mode": "FAILFAST"})
    kept = [c for c in payloads.columns if c != payload]
    return payloads.select(*kept, parsed.alias("envelope")).select(*kept, "envelope.*")


def explode_records(envelopes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per record (``record``) with carried envelope columns; empty pages vanish."""
    return envelopes.select(*carry, F.explode("data").alias("record"))


def project_records(
    records: DataFrame, columns: Iterable[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Records -> named text columns: absent keys give null, other keys are dropped."""
    if isinstance(records.schema["record"].dataType, T.StructType):
        known = set(records.schema["record"].dataType.names)
        picked = [
            (F.col("record").getField(c) if c in known else F.lit(None).cast("string")).alias(c)
            for c in columns
        ]
    else:
        picked = [F.col("record").getItem(c).alias(c) for c in columns]
    return records.select(*picked, *carry)


def all_fields(
    records: DataFrame, columns: Sequence[str], carry: Sequence[str] = (), other: str = OTHER
) -> DataFrame:
    """Records of map type -> named text columns, and a map ``other`` of what is left.

    A name is looked up as it stands, then without regard to case, where the first spelling
    counts; every other spelling is left. Null records vanish.
    """
    declared = F.create_map(*(F.lit(x) for c in columns for x in (c.lower(), c)))
    low = [c.lower() for c in columns]
    odd = F.map_filter("record", lambda k, _: ~k.isin(list(columns)))
    split = records.filter(F.col("record").isNotNull()).withColumn("_odd", odd)

    def pick(column: str) -> Column:
        same = F.map_filter("_odd", lambda k, _: F.lower(k) == column.lower())
        late = F.when(F.size("_odd") > 0, F.get(F.map_values(same), F.lit(0)))
        return F.coalesce(F.col("record").getItem(column), late).alias(column)

    spelled = F.filter(F.map_keys("_odd"), lambda k: F.lower(k).isin(low))
    taken = F.filter(
        spelled,
        lambda k, i: F.col("record")[declared[F.lower(k)]].isNull()
        & (F.array_position(F.transform(spelled, F.lower), F.lower(k)) == i + 1),
    )
    rest = F.when(
        F.size(spelled) > 0, F.map_filter("_odd", lambda k, _: ~F.array_contains(taken, k))
    ).otherwise(F.col("_odd"))
    return split.select(*map(pick, columns), *carry, F.when(F.size(rest) > 0, rest).alias(other))


def null_records() -> Column:
    """How many elements of all pages are null."""
    return F.sum(F.size(F.filter("data", lambda r: r.isNull())))


def child_records(envelopes: DataFrame, columns: Sequence[str], parent: str) -> DataFrame:
    """Records of per-parent envelopes, each stamped with its parent's id."""
    own = [c for c in columns if c != parent]
    return project_records(explode_records(envelopes, [parent]), own, [parent])


def distinct_parents(parents: DataFrame, key: str) -> DataFrame:
    return parents.select(key).distinct()


def missing_parents(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents for which no child record landed.

    Both sides are reduced to distinct keys, so a parent with very many children
    counts as one row in the join.
    """
    return distinct_parents(parents, key).join(distinct_parents(children, key), key, "left_anti")


def is_last_page() -> Column:
    """True for a page that ends its set: nothing more announced, or no records."""
    announced = F.coalesce(F.col("meta.hasMore"), F.lit(False))
    return ~announced | (F.coalesce(F.size("data"), F.lit(0)) <= 0)


def page_completeness(envelopes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pages per set and whether a last page is among them."""
    return envelopes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("pages"),
        F.coalesce(F.bool_or(is_last_page()), F.lit(False)).alias("complete"),
    )


def page_of_file(path: Column, pattern: str) -> tuple[Column, Column]:
    """The page that a file's name gives (first group of ``pattern``), and the set it is one of.

    The set is the path up to the match; both are null where nothing matches.
    """
    page = F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).try_cast("long")
    return page, F.when(page.isNotNull(), F.regexp_extract(path, f"^(.*?)(?:{pattern})", 1))


def page_of_envelope() -> Column:
    """The page number an envelope carries in ``meta.page``; null without a number."""
    return F.col("meta.page").try_cast("long")


def page_gaps(
    pages: DataFrame, by: Sequence[str] = (), page: str = "page", first: int = 1, block: int = 1 << 20
) -> DataFrame:
    """by..., first_missing, last_missing: the runs of page numbers that a set lacks.

    Pages are numbered from ``first`` on; of pages past the last that is there nothing is known
    (see :func:`page_completeness`). Null pages are left out, repeated ones count once. Windows
    run over blocks of numbers, then over one row per block, so a set may be large.
    """
    at = F.col(page)
    known = pages.select(*by, at.cast("long").alias(page)).where(at.isNotNull() & (at >= first)).distinct()
    known = known.withColumn("_block", F.floor(at / block))
    before = F.lag(page).over(Window.partitionBy(*by, "_block").orderBy(page))
    inside = known.withColumn("_before", before).select(*by, "_before", at.alias("_page"))
    edges = known.groupBy(*by, "_block").agg(F.min(page).alias("_page"), F.max(page).alias("_last"))
    last = F.lag("_last").over(Window.partitionBy(*by).orderBy("_block"))
    between = edges.select(*by, F.coalesce(last, F.lit(first - 1)).alias("_before"), "_page")
    runs = inside.unionByName(between).where(F.col("_page") - F.col("_before") > 1)
    return runs.select(
        *by, (F.col("_before") + 1).alias("first_missing"), (F.col("_page") - 1).alias("last_missing")
    )
