"""Loads of single tables and of the whole lakehouse.

Rows are counted while they are written; rows of a source table are counted from its
file footers, without reading a column. Tables are the only thing that passes from one
load to the next.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlode.functions.clock import STAMP
from starlode.operators.conform import EntitySpec, conform, newest_rows
from starlode.operators.dedup import dealt_text
from starlode.operators.guards import key_faults, require_unique
from starlode.operators import folders
from starlode.operators.buckets import (
    BucketStore,
    commit_buckets,
    current_state,
    latest_generation,
    lost_buckets,
    touched_since,
)
from starlode.operators.load import (
    FOLDER_FORMATS,
    FULL,
    INCREMENTAL,
    LoadPlan,
    counted,
    highest,
    newer_than,
    open_table,
    plan_load,
    set_table_properties,
    stamp_load,
    table_location,
    table_property,
    watermark_key,
    without_stamp,
    write_table,
)
from starlode.operators.loads import (
    Ledger,
    Load,
    Overtaken,
    append_load,
    file_format,
    ledger,
    replace_loads,
    uncovered,
)
from starlode.plans.entities import ENTITIES, SILVER
from starlode.plans.lakehouse import Lakehouse, LoadReport
from starlode.plans.star_schema import DIMENSIONS, FACTS, FactSpec, build_gold, gold_key
from starlode.session import apply_sizing
from starlode.sources.landing import (
    OTHER,
    all_fields,
    explode_records,
    is_last_page,
    landed_files,
    literal_path,
    missing_parents,
    new_files,
    null_records,
    page_gaps,
    page_of_file,
    read_envelopes,
)
from starlode.sources.shared import materialize

log = logging.getLogger("starlode")

#: Property of a Gold table whose keys were found unique: its folder and number of rows then.
UNIQUE = "starlode.unique_rows"
#: Partition column of Silver tables built by deltas.
BUCKET = "key_bucket"

Name = TypeVar("Name")
Result = TypeVar("Result")


def in_parallel(
    load: Callable[[Name], Result], names: Iterable[Name], at_once: int = 4
) -> list[Result]:
    """Run independent Spark jobs side by side; results keep the order of ``names``."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(load, names))


def bronze_rows(envelopes: DataFrame, spec: EntitySpec) -> DataFrame:
    """Envelopes with map records -> all-text rows of the declared columns.

    What is not declared stays in the map column ``other_fields``, so no landed field is lost.
    Records of undeclared entities stay maps, beside their watermark. Null records vanish.
    """
    carry = [spec.parent] if spec.parent else []
    records = explode_records(envelopes, carry)
    if not spec.types:
        dated = [F.col("record").getItem(c).alias(c) for c in (spec.watermark,) if c]
        return records.filter(F.col("record").isNotNull()).select(*dated, "record")
    own = [c for c in spec.types if c not in carry]
    return all_fields(records, own, carry).select(*spec.types, OTHER)


def stamped_bronze(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    """Add the audit column; entities without a stamp keep it null."""
    if spec.stamped:
        return stamp_load(rows)
    return rows.withColumn(STAMP, F.lit(None).cast("timestamp"))


#: Fixed value: how the files of numbered pages are called; the first group is the number.
PAGE_FILE = r"page[-_]?(\d+)[^/]*$"
#: Column with the text of a malformed page, in a table of its own.
REJECTED = "page"
#: How often a load is planned anew because another one was committed meanwhile.
ATTEMPTS = 5


def run_bronze(
    spark: SparkSession,
    lake: Lakehouse,
    entity: str,
    landing: str,
    *,
    force_full: bool = False,
    inclusive: bool = False,
    file_per_envelope: bool = False,
    parent_pattern: str | None = None,
    check_parents: bool = True,
    reread: bool = False,
    quarantine: bool = False,
    page_pattern: str = PAGE_FILE,
) -> LoadReport:
    """Landed pages -> Bronze table, in full or past the watermark.

    An incremental load reads files that no load has read before and nothing else; ``reread``
    reads all that is landed, as does a full load. The files, the watermark and the rows are
    committed together, so a load that dies has read nothing, and of two loads at once the later
    one plans anew. A full load of nothing leaves the table as it is.

    The report tells from the same pass whether a last page was among those read, how many
    records were null and how many rows have no watermark value; such rows are loaded with the
    file they are in. It counts the pages that numbered files lack (``page_pattern``, first group
    of the name). ``quarantine`` puts malformed pages into the table ``<entity>_rejected`` instead
    of failing. ``check_parents`` counts, for a child entity, the parents in Bronze without a
    child there.
    """
    spec = ENTITIES[entity]
    table = lake.table("bronze", entity)
    kind = spec.types.get(spec.watermark)

    def read(path: str | list[str], base: str | None = None) -> DataFrame:
        return bronze_envelopes(
            spark, spec, path, base, file_per_envelope, parent_pattern, CORRUPT if quarantine else None
        )

    def load() -> LoadReport:
        before = ledger(spark, table)
        if before is None or force_full or not spec.watermark:
            plan = plan_load(spark, table, spec.watermark, force_full, kind)
        else:
            high = before.watermarks.get(spec.watermark)
            plan = LoadPlan(FULL) if high is None else LoadPlan(INCREMENTAL, high)
        files = landed_files(spark, landing)
        if plan.incremental and before and not reread:
            files = materialize(new_files(files, before.files(spark)), "new-files")
            # as many as Spark itself would list; those of earlier loads are not among them
            paths = [literal_path(r["path"]) for r in files.select("path").collect()]
            if not paths:
                return _reported(LoadReport(table, None, files=0))
            envelopes = read(paths, _folder_of(spark, landing))
        else:
            files = materialize(files, "landed-files")
            envelopes = read(landing)
            if not plan.incremental and explode_records(envelopes).isEmpty():
                return _reported(LoadReport(table, None))
        return load_envelopes(
            spark,
            lake,
            entity,
            envelopes,
            plan,
            before,
            files,
            inclusive=inclusive,
            check_parents=check_parents,
            quarantine=quarantine,
            page_pattern=page_pattern,
        )

    for attempt in range(ATTEMPTS):
        try:
            return load()
        except Overtaken:
            log.info("%s: another load came first, attempt %d", table, attempt + 1)
    raise Overtaken(table)


def _folder_of(spark: SparkSession, landing: str) -> str | None:
    return landing if folders.is_folder(spark, landing) else None


#: Columns of envelopes: the text of a malformed one, and the file it came from.
CORRUPT, FILE = "_corrupt", "_file"


def bronze_envelopes(
    spark: SparkSession,
    spec: EntitySpec,
    path: str | list[str],
    base: str | None = None,
    file_per_envelope: bool = False,
    parent_pattern: str | None = None,
    corrupt: str | None = None,
    stream: bool = False,
) -> DataFrame:
    """The landed pages of an entity and the file of each, for batch loads and streams alike."""
    envelopes = read_envelopes(
        spark,
        path,
        carried=[spec.parent] if spec.parent and not parent_pattern else [],
        file_per_envelope=file_per_envelope,
        parent=spec.parent,
        parent_pattern=parent_pattern if spec.parent else None,
        corrupt=corrupt,
        base=base,
        stream=stream,
    )
    return envelopes.withColumn(FILE, F.col("_metadata.file_path"))


def load_envelopes(
    spark: SparkSession,
    lake: Lakehouse,
    entity: str,
    envelopes: DataFrame,
    plan: LoadPlan,
    before: Ledger | None,
    files: DataFrame,
    *,
    inclusive: bool = False,
    check_parents: bool = True,
    quarantine: bool = False,
    page_pattern: str = PAGE_FILE,
    by_watermark: bool = True,
    batch: tuple[str, int] | None = None,
) -> LoadReport:
    """Commit envelopes, and the ``files`` they come from, as one load of a Bronze table.

    ``by_watermark`` leaves out what is not newer; ``batch`` is the stream and the number of the
    batch, noted with the load.
    """
    spec, table = ENTITIES[entity], lake.table("bronze", entity)
    kind = spec.types.get(spec.watermark)
    metrics = {"complete": F.bool_or(is_last_page()), "nulls": null_records()}
    if quarantine:
        whole = F.col(CORRUPT).isNull()
        metrics = {"complete": F.bool_or(is_last_page() & whole), "nulls": null_records(), "rejected": F.count_if(~whole)}
    pages, observed = counted(envelopes, f"pages of {table}", **metrics)
    rows = bronze_rows(pages.where(F.col(CORRUPT).isNull()) if quarantine else pages, spec)
    seen = None
    if plan.incremental and by_watermark:
        rows = newer_than(rows, spec.watermark, plan.watermark, inclusive, kind)
    if spec.watermark:
        rows, seen = counted(
            rows,
            f"versions of {table}",
            undated=F.count_if(F.col(spec.watermark).isNull()),
            high=highest(spec.watermark, kind),
        )

    def noted() -> dict[str, dict[str, object]]:
        if quarantine and observed.get["rejected"]:
            _put_aside(lake, entity, envelopes, plan)
        high = _later(spark, seen.get["high"], plan.watermark, kind) if seen else None
        return {
            "watermarks": {spec.watermark: high} if high else {},
            "batches": dict([batch]) if batch else {},
        }

    stamped = stamped_bronze(rows, spec)
    bucket_by = lake.buckets.get(f"bronze.{entity}")
    if file_format(spark) not in FOLDER_FORMATS or (plan.incremental and before is None):
        written = _write(lake, "bronze", entity, stamped, plan.mode)
        for column, high in noted()["watermarks"].items():
            set_table_properties(spark, table, {watermark_key(column): high})
    else:
        load = Load(stamped, files, noted, bucket_by, (spec.parent or spec.key) if spec.types else None)
        if plan.incremental:
            written = append_load(spark, table, load, before)
        else:
            written = replace_loads(spark, table, load, lake.home(spark, "bronze", entity))
    found = observed.get
    known = files if not plan.incremental or before is None else files.unionByName(before.files(spark))
    return _reported(
        LoadReport(
            table,
            plan.mode,
            written,
            complete=bool(found["complete"]),
            undated=seen.get["undated"] if seen else None,
            null_records=max(found["nulls"] or 0, 0),
            missing_parents=_childless(spark, lake, spec) if check_parents else None,
            files=files.count(),
            missing_pages=_missing_pages(known, page_pattern),
            rejected=found["rejected"] if quarantine else None,
        )
    )


def _later(spark: SparkSession, one: str | None, other: str | None, kind: str | None) -> str | None:
    """The later of two watermarks, by the type of the column."""
    if one is None or other is None:
        return one or other
    pair = spark.createDataFrame([(one,), (other,)], "value string")
    return pair.agg(highest("value", kind).alias("high")).first()["high"]


def _missing_pages(files: DataFrame, pattern: str) -> int | None:
    page, pages_of = page_of_file(F.col("path"), pattern)
    numbered = files.select(pages_of.alias("set"), page.alias("page")).where(F.col("page").isNotNull())
    gaps = page_gaps(numbered, ["set"]).agg(F.sum(F.col("last_missing") - F.col("first_missing") + 1).alias("n"))
    missing = gaps.first()["n"]
    return missing or (None if numbered.isEmpty() else 0)


def _put_aside(lake: Lakehouse, entity: str, envelopes: DataFrame, plan: LoadPlan) -> None:
    """Malformed pages -> ``<entity>_rejected``: the file, the page as it landed, and the time."""
    # Spark reads the text of malformed pages only together with a field of theirs
    any_data = F.coalesce(F.size("data"), F.lit(-1)) >= -1
    bad = envelopes.where(F.col(CORRUPT).isNotNull() & any_data)
    bad = bad.select(F.col(FILE).alias("file"), F.col(CORRUPT).alias(REJECTED))
    _write(lake, "bronze", f"{entity}_rejected", stamp_load(bad), plan.mode)


def _childless(spark: SparkSession, lake: Lakehouse, spec: EntitySpec) -> int | None:
    """Parents in Bronze for which no child is there; None if there is nothing to compare."""
    if not spec.parent:
        return None
    parent = next(e for e in SILVER.values() if e.key == spec.parent)
    if not spark.catalog.tableExists(lake.table("bronze", parent.name)):
        return None
    tables = [lake.table("bronze", e.name) for e in (parent, spec)]
    noted = [found.keys(spark) if (found := ledger(spark, t)) else None for t in tables]
    if all(keys is not None for keys in noted):
        return uncovered(*noted)  # no row of either table is read
    parents, children = (spark.read.table(t) for t in tables)
    return missing_parents(parents, children, spec.parent).count()


def _write(lake: Lakehouse, layer: str, name: str, df: DataFrame, mode: str) -> int:
    return write_table(
        df,
        lake.table(layer, name),
        mode,
        path=lake.path(layer, name),
        bucket_by=lake.buckets.get(f"{layer}.{name}"),
    )


def _reported(report: LoadReport) -> LoadReport:
    log.info("%s", report)
    if report.key_collisions:
        log.warning(
            "%s: %d surrogate keys stand for several natural keys; the method xxhash64 has 64 bits",
            report.table,
            report.key_collisions,
        )
    if report.duplicate_keys:
        log.warning("%s: %d keys occur more than once", report.table, report.duplicate_keys)
    return report


def _save(
    lake: Lakehouse, layer: str, name: str, df: DataFrame, source: DataFrame
) -> LoadReport:
    written = _write(lake, layer, name, stamp_load(df), FULL)
    return _reported(LoadReport(lake.table(layer, name), FULL, written, source.count()))


def run_silver(
    spark: SparkSession, lake: Lakehouse, entity: str, keep: str | None = None
) -> LoadReport:
    """Bronze table -> Silver table, always in full."""
    bronze = without_stamp(open_table(spark, lake.table("bronze", entity)))
    return _save(lake, "silver", entity, conform(bronze, SILVER[entity], keep), bronze)


def run_silver_delta(
    spark: SparkSession, lake: Lakehouse, entity: str, buckets: int = 256
) -> LoadReport:
    """Bronze loads that Silver has not taken yet -> Silver, rewriting only buckets they touch.

    Keys are dealt into ``buckets``, the partitions of the Silver table and of a table
    ``<entity>_versions`` with the newest Bronze row of every key. A touched bucket is made anew
    from its versions and the new rows, by the rules of a full load, so both give the same rows,
    and lies in a new folder; all the others keep their files.

    What Silver consists of is one record: up to which Bronze load it goes, and the folder of
    every bucket. Writing it commits a run. The catalog follows the record, and folders that it no
    longer names go last, so a run that dies before the record has changed nothing, and one that
    dies after it is completed by the next. A bucket whose folder is lost is made anew from all of
    Bronze. The first run, and any after ``run_silver``, a replaced Bronze table or another number
    of ``buckets``, takes all of Bronze; so does every run over a table not made of loads.
    """
    for attempt in range(ATTEMPTS):
        try:
            return _silver_delta(spark, lake, entity, buckets)
        except Overtaken:
            log.info("silver %s: another run came first, attempt %d", entity, attempt + 1)
    raise Overtaken(lake.table("silver", entity))


def _silver_delta(spark: SparkSession, lake: Lakehouse, entity: str, buckets: int) -> LoadReport:
    spec, source = SILVER[entity], lake.table("bronze", entity)
    stores = [
        BucketStore(lake.table("silver", name), lake.home(spark, "silver", name))
        for name in (entity, f"{entity}_versions")
    ]
    silver, versions = stores
    state = current_state(spark, stores)
    loads = ledger(spark, source)
    if state and (loads is None or state.source != loads.generation or state.buckets != buckets):
        state = None
    bronze = open_table(spark, source)

    def bucket_of(key: Column) -> Column:
        """By the value, not by its spelling: equal keys of Silver must share a bucket."""
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int").alias(BUCKET)

    bucket = bucket_of(F.col(spec.key).try_cast(spec.types[spec.key]))
    until = loads.numbers[-1] if loads and loads.numbers else 0
    lost = lost_buckets(spark, stores, state) if state else []
    if state is None:
        rows = bronze
    else:
        rows = loads.rows(spark, source, [i for n, i in zip(loads.numbers, loads.ids, strict=True) if n > state.until])
    rows, seen = counted(rows, f"news of {silver.table}")
    rows = materialize(rows.select(*spec.types, bucket), f"{entity}-news")
    newest_schema = rows.select(*spec.types).schema
    if not seen.get["rows"] and not lost:
        return _reported(LoadReport(silver.table, None))
    if state is None:
        touched = list(range(buckets))
    else:
        found = [r[BUCKET] for r in rows.select(BUCKET).distinct().collect()]  # <= buckets
        touched = sorted({*found, *lost})
        kept = [b for b in touched if b not in lost]
        rows = rows.unionByName(versions.rows(spark, state, kept, newest_schema).select("*", bucket))
        if lost:
            log.warning("%s: %d buckets are lost and made anew", silver.table, len(lost))
            rows = rows.unionByName(bronze.select(*spec.types, bucket).where(F.col(BUCKET).isin(lost)))
    newest = newest_rows(rows, spec)
    # dealt into buckets once, for both stores
    newest = materialize(dealt_text(newest.select("*", bucket), BUCKET), f"{entity}-versions")
    made = stamp_load(conform(newest.select(*spec.types), spec, "all"))
    made = made.withColumn(BUCKET, bucket_of(F.col(spec.key)))
    made, written = counted(made, f"rows of {silver.table}")
    built_on = loads.generation if loads else ""
    commit_buckets(spark, stores, [made, newest], state, touched, BUCKET, buckets, built_on, until, True)
    mode = FULL if state is None else INCREMENTAL
    return _reported(LoadReport(silver.table, mode, written.get["rows"], seen.get["rows"]))


def stored(spark: SparkSession, table: str) -> DataFrame:
    """A table, however it was built; a bound on the buckets lets Spark see its real size."""
    rows = open_table(spark, table)
    return rows.where(F.col(BUCKET) >= 0).drop(BUCKET) if BUCKET in rows.columns else rows


def run_gold(
    spark: SparkSession,
    lake: Lakehouse,
    name: str,
    method: str = "crc32",
    check_unique: bool = True,
    where: Column | None = None,
) -> LoadReport:
    """Silver (and for facts Gold) tables -> Gold table, always in full.

    The keys of the written table are checked: the report counts repeated natural and shared
    surrogate keys, and a table found unique is marked with its number of rows.
    ``check_unique`` stops a table that links one with a repeated key; without the check such
    a key multiplies rows. Marked tables are taken as checked, so a fact that is linked is not
    grouped again. ``where`` leaves rows out of a current-state dimension.
    """

    def silver(entity: str) -> DataFrame:
        return without_stamp(stored(spark, lake.table("silver", entity)))

    def gold(table: str) -> DataFrame:
        return without_stamp(stored(spark, lake.table("gold", table)))

    if check_unique and name in FACTS:
        for link in FACTS[name].links:
            if not _marked_unique(spark, lake.table("gold", link.dimension)):
                require_unique(gold(link.dimension), link.natural, link.dimension)
    if check_unique and name == "dim_usuario":
        require_unique(silver("user_types"), "userTypeId", "user_types")
    source = (DIMENSIONS | FACTS)[name].source
    built = build_gold(name, silver, gold, method, where)
    table = lake.table("gold", name)
    written = _write(lake, "gold", name, stamp_load(built), FULL)
    repeated, shared = key_faults(spark.read.table(table), *gold_key(name))
    if not repeated:
        set_table_properties(spark, table, {UNIQUE: f"{written} {table_location(spark, table)}"})
    return _reported(
        LoadReport(
            table,
            FULL,
            written,
            silver(source).count(),
            duplicate_keys=repeated,
            key_collisions=shared,
        )
    )


def run_gold_delta(
    spark: SparkSession, lake: Lakehouse, name: str, method: str = "crc32", check_unique: bool = True
) -> LoadReport:
    """A fact made anew only in the buckets that changes reach; equal to what ``run_gold`` makes.

    Silver must be built by ``run_silver_delta``; the fact has its buckets. A bucket is reached if
    Silver changed it since the last run, or if one of its rows refers to a key that a linked
    table has gained, lost or renumbered since. For that the fact keeps two things: a table
    ``<fact>_links`` of the keys each bucket refers to, and the keys of the linked tables as they
    were. Untouched buckets keep their files. The first run takes all buckets, as does one that
    finds Silver built anew or its last changes no longer on record. Commits are those of
    ``run_silver_delta``.
    """
    for attempt in range(ATTEMPTS):
        try:
            return _gold_delta(spark, lake, name, method, check_unique)
        except Overtaken:
            log.info("gold %s: another run came first, attempt %d", name, attempt + 1)
    raise Overtaken(lake.table("gold", name))


def _gold_delta(
    spark: SparkSession, lake: Lakehouse, name: str, method: str, check_unique: bool
) -> LoadReport:
    spec = FACTS[name]
    entity = spec.source
    below = [
        BucketStore(lake.table("silver", n), lake.home(spark, "silver", n)) for n in (entity, f"{entity}_versions")
    ]
    silver = current_state(spark, below)
    if silver is None:
        raise ValueError(f"{below[0].table} has no buckets; build it by run_silver_delta")
    stores = [BucketStore(lake.table("gold", n), lake.home(spark, "gold", n)) for n in (name, f"{name}_links")]
    fact, links = stores

    def gold(table: str) -> DataFrame:
        return without_stamp(stored(spark, lake.table("gold", table)))

    if check_unique:
        for link in spec.links:
            if not _marked_unique(spark, lake.table("gold", link.dimension)):
                require_unique(gold(link.dimension), link.natural, link.dimension)
    keys = _linked_keys(spec, gold)
    state = current_state(spark, stores)
    changed = None
    if state is not None and state.buckets == silver.buckets:
        known_silver, _, known_keys = state.source.partition("|")
        changed = touched_since(spark, below, state.until, known_silver)
    if changed is not None:
        schema = keys.schema
        old = spark.read.schema(schema).parquet(f"{fact.root}/{known_keys}")
        moved = materialize(keys.exceptAll(old).unionByName(old.exceptAll(keys)), f"{name}-changed-keys")
        referring = open_table(spark, links.table).join(moved.select("dimension", "natural").distinct(), ["dimension", "natural"])
        reached = [r[BUCKET] for r in referring.select(BUCKET).distinct().collect()]  # <= buckets
        changed = sorted({*changed, *reached, *lost_buckets(spark, stores, state)})
        if not changed:
            return _reported(LoadReport(fact.table, None))
    touched = list(range(silver.buckets)) if changed is None else changed
    rows = without_stamp(open_table(spark, below[0].table)).where(F.col(BUCKET).isin(touched))
    made = build_gold(name, lambda _: rows, gold, method)

    def bucket_of(key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(silver.buckets)).cast("int")

    made, written = counted(stamp_load(made).withColumn(BUCKET, bucket_of(spec.natural)), f"rows of {fact.table}")
    refers = F.array(
        *(F.struct(F.lit(x.dimension).alias("dimension"), F.col(x.foreign).cast("string").alias("natural")) for x in spec.links)
    )
    referred = rows.select(F.explode(refers).alias("link"), BUCKET).select("link.*", BUCKET)
    referred = referred.where(F.col("natural").isNotNull()).distinct()
    snapshot = f"_keys-{uuid.uuid4().hex}"
    keys.write.parquet(f"{fact.root}/{snapshot}")
    commit_buckets(
        spark,
        stores,
        [made, referred],
        state if changed is not None else None,
        touched,
        BUCKET,
        silver.buckets,
        f"{latest_generation(silver, below[0])}|{snapshot}",
        silver.number,
    )
    for old_keys in folders.children(spark, fact.root):
        if old_keys.startswith("_keys-") and state and old_keys == state.source.partition("|")[2]:
            folders.remove(spark, f"{fact.root}/{old_keys}")
    return _reported(
        LoadReport(fact.table, FULL if changed is None else INCREMENTAL, written.get["rows"], rows.count())
    )


def _linked_keys(spec: FactSpec, gold: Callable[[str], DataFrame]) -> DataFrame:
    """dimension, natural, surrogate of all that a fact may refer to."""
    parts = [
        gold(link.dimension).select(
            F.lit(link.dimension).alias("dimension"),
            F.col(link.natural).cast("string").alias("natural"),
            F.col(link.surrogate).cast("long").alias("surrogate"),
        )
        for link in spec.links
    ]
    keys = parts[0]
    for part in parts[1:]:
        keys = keys.unionByName(part)
    return materialize(keys.where(F.col("natural").isNotNull()), f"{spec.name}-keys")


def _marked_unique(spark: SparkSession, table: str) -> bool:
    """Checked when it was written, and of the same folder and number of rows since."""
    mark = table_property(spark, table, UNIQUE)
    if mark is None or not mark.endswith(f" {table_location(spark, table)}"):
        return False
    return int(mark.split(" ")[0]) == spark.read.table(table).count()


def run_all(
    spark: SparkSession,
    lake: Lakehouse,
    landing: str,
    entities: Iterable[str] = tuple(SILVER),
    concurrent_loads: int = 4,
    method: str = "crc32",
    sized: bool = False,
    load: Callable[..., LoadReport] | None = None,
    **bronze_options: object,
) -> list[LoadReport]:
    """``<landing>/<entity>`` -> Bronze -> Silver -> dimensions -> facts.

    The loads of a layer do not depend on each other and share the executors; ``sized`` sizes
    the session per layer, by all it reads. Child entities come after their parents. ``load``
    takes the place of ``run_bronze``.
    """
    lake.create_databases(spark)
    entities = list(entities)

    def size(sources: Iterable[DataFrame]) -> None:
        if sized:
            apply_sizing(spark, sources)

    def bronze(entity: str) -> LoadReport:
        path = f"{landing.rstrip('/')}/{entity}"
        return (load or run_bronze)(spark, lake, entity, path, **bronze_options)

    size(spark.read.text(f"{landing.rstrip('/')}/{e}") for e in entities)
    order = sorted(entities, key=lambda e: ENTITIES[e].parent is not None)
    own = [e for e in order if not ENTITIES[e].parent]
    loaded = in_parallel(bronze, own, concurrent_loads)
    loaded += in_parallel(bronze, order[len(own) :], concurrent_loads)
    reports = [loaded[order.index(e)] for e in entities]
    size(spark.read.table(lake.table("bronze", e)) for e in entities)
    reports += in_parallel(lambda e: run_silver(spark, lake, e), entities, concurrent_loads)
    size(stored(spark, lake.table("silver", e)) for e in entities)
    reports += in_parallel(
        lambda dim: run_gold(spark, lake, dim, method), DIMENSIONS, concurrent_loads
    )
    reports += [run_gold(spark, lake, fact, method) for fact in FACTS]
    return reports
