"""One query per operator, source, sink and published table, over the test tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlode.functions import (
    blank_to,
    deletion_label,
    digits_only,
    empty_list_to,
    empty_to,
    empty_to_upper,
    local_wall_clock,
    null_to_upper,
    platform_label,
    postal_code,
    state_code,
    state_or_extracted,
    status_label,
    surrogate_key,
    trim_lower,
    trim_upper,
    yes_no,
    zero_fill,
)
from starlode.operators import (
    DimensionLink,
    any_by_key,
    conform,
    counted,
    distinct_values,
    fanout_guard,
    key_collisions,
    latest_by_key,
    link_dimensions,
    newer_than,
    plan_load,
    rename,
    stamp_load,
    without_stamp,
    write_table,
)
from starlode.operators.keymap import register_keys, with_registered_key
from starlode.operators.load import FULL, INCREMENTAL, high_watermark
from starlode.plans import (
    DIMENSIONS,
    FACTS,
    SILVER,
    Lakehouse,
    build_gold,
    run_bronze,
    run_gold,
    run_gold_delta,
    run_silver,
)
from starlode.plans.entities import ENTITIES
from starlode.plans.jobs import BUCKET, in_parallel, run_silver_delta
from starlode.plans.star_schema import ROW_KEY, linked_tables
from starlode.sources import (
    OTHER,
    child_records,
    distinct_parents,
    explode_records,
    materialize,
    missing_parents,
    page_completeness,
    page_gaps,
    parse_envelopes,
    project_records,
    read_envelopes,
    shared_path,
    string_schema,
)
from starlode.streaming import stream_bronze
from starlode.verification import frames
from starlode.verification.frames import as_wall_clock, child_pages, pages, table, text_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name, less a trailing ``_`` that avoids an import."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def fresh_name(stem: str) -> str:
    """Table or view name no other run uses."""
    return f"starlode_{stem}_{uuid.uuid4().hex}"


def scanned(spark: SparkSession, name: str, sql: bool = False) -> DataFrame:
    """Scan of an external table that then leaves the catalog; its files stay."""
    df = spark.sql(f"SELECT * FROM {name}") if sql else spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")
    return df


def text_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# --- sources ---------------------------------------------------------------------------


@query
def land_pages(spark, sf_dir):
    """Conversation turns packed into text pages, parsed and exploded again."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    payloads = pages(turns, ["conv_id", "turn", "role"]).select(text_of().alias("page"))
    records = explode_records(parse_envelopes(payloads, "page", ["conv_id", "turn", "role"]))
    return project_records(records, ["conv_id", "turn", "role"]).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role"
    )


@query
def single_envelope(spark, sf_dir):
    """One envelope per turn, read without looking at its paging flag."""
    turns = table(spark, sf_dir, "conversations")
    payloads = turns.select(
        F.to_json(F.struct(F.array(F.struct("conv_id", "turn", "role")).alias("data"))).alias("page")
    )
    records = explode_records(parse_envelopes(payloads, "page"))
    return project_records(records, ["conv_id", "turn", "role", "absent"]).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "absent"
    )


@query
def child_scan_parent_stamp(spark, sf_dir):
    """Turns fetched per conversation: the id comes from the envelope, not the record."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    payloads = child_pages(turns, ["turn", "role"], "conv_id").select(
        "conv_id", text_of().alias("page")
    )
    envelopes = parse_envelopes(payloads, "page", ["turn", "role"])
    return child_records(envelopes, ["turn", "role"], "conv_id").select(
        "conv_id", F.col("turn").cast("long"), "role"
    )


@query
def distinct_parent_list(spark, sf_dir):
    return distinct_parents(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def missing_children(spark, sf_dir):
    return missing_parents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id"
    )


@query
def page_completeness_(spark, sf_dir):
    """Each turn is a page that announces more unless it is a system turn."""
    turns = table(spark, sf_dir, "conversations")
    envelopes = turns.select(
        "conv_id",
        F.array(F.struct("turn")).alias("data"),
        F.struct((F.col("role") != "system").alias("hasMore")).alias("meta"),
    )
    return page_completeness(envelopes, ["conv_id"])


@query
def bronze_stringify(spark, sf_dir):
    """All-text frame by schema, with a declared column no record has."""
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_absent"]
    schema = string_schema(columns, stamp=False)
    records = orders.select(
        F.from_json(F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")), schema)
        .alias("record")
    )
    return project_records(records, columns)


@query
def table_scan(spark, sf_dir):
    name = fresh_name("scan")
    write_table(table(spark, sf_dir, "supplier"), name, path=shared_path(spark, name))
    return scanned(spark, name)


@query
def sql_scan(spark, sf_dir):
    name = fresh_name("sql")
    write_table(table(spark, sf_dir, "part"), name, path=shared_path(spark, name))
    return scanned(spark, name, sql=True)


@query
def temp_view_sql(spark, sf_dir):
    name = fresh_name("view")
    table(spark, sf_dir, "customer").createOrReplaceTempView(name)
    return spark.sql(
        f"SELECT c_custkey, TRIM(UPPER(c_mktsegment)) AS segment, c_acctbal FROM {name}"
    )


# --- load control ----------------------------------------------------------------------


def _old_and_new(spark, sf_dir):
    """Events as text, and the instant halfway through their time range."""
    events = table(spark, sf_dir, "events")
    half = events.agg(
        (F.min("ts") + (F.max("ts") - F.min("ts")) / 2).cast("string").alias("half")
    ).first()["half"]
    bronze = text_columns(events.select("event_id", "ts", "user_id", "event_type"))
    return bronze, half


@query
def watermark_max(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(
        F.max(F.col("ts").cast("string")).alias("watermark")
    )


@query
def incremental_filter(spark, sf_dir):
    """Events past the watermark of those that were loaded first."""
    bronze, half = _old_and_new(spark, sf_dir)
    loaded = bronze.filter(F.col("ts") <= half)
    return newer_than(bronze, "ts", high_watermark(loaded, "ts"))


@query
def incremental_append(spark, sf_dir):
    """First load, then a second one that appends what the watermark left out."""
    bronze, half = _old_and_new(spark, sf_dir)
    name = fresh_name("append")
    path = shared_path(spark, name)
    first = plan_load(spark, name, "ts")
    write_table(stamp_load(bronze.filter(F.col("ts") <= half)), name, first.mode, path=path)
    second = plan_load(spark, name, "ts")
    delta = newer_than(bronze, "ts", second.watermark)
    write_table(stamp_load(delta), name, second.mode, path=path)
    if (first.mode, second.mode) != (FULL, INCREMENTAL):
        raise AssertionError(f"unexpected load modes {first.mode}, {second.mode}")
    return without_stamp(scanned(spark, name))


@query
def full_overwrite(spark, sf_dir):
    """Two full loads leave the rows of one."""
    name = fresh_name("full")
    path = shared_path(spark, name)
    customers = table(spark, sf_dir, "customer")
    for _ in range(2):
        write_table(customers, name, plan_load(spark, name).mode, path=path)
    return scanned(spark, name)


@query
def load_type_cases(spark, sf_dir):
    """Each way to a load type, decided on the events table."""
    events = table(spark, sf_dir, "events").select(
        F.col("ts").cast("string").alias("ts"), F.lit(None).cast("string").alias("never")
    )
    name = fresh_name("events")
    events.createOrReplaceTempView(name)
    plans = {
        "forced": plan_load(spark, name, "ts", force_full=True),
        "missing table": plan_load(spark, fresh_name("missing"), "ts"),
        "no column": plan_load(spark, name),
        "null maximum": plan_load(spark, name, "never"),
        "incremental": plan_load(spark, name, "ts"),
    }
    return spark.createDataFrame(
        [(case, plan.mode, plan.watermark) for case, plan in plans.items()],
        "load_case string, mode string, watermark string",
    )


@query
def table_exists(spark, sf_dir):
    """Rows of a table that exists, and whether a made-up name does."""
    name = fresh_name("exists")
    table(spark, sf_dir, "orders").createOrReplaceTempView(name)
    return spark.read.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(spark.catalog.tableExists(name)).alias("there"),
        F.lit(spark.catalog.tableExists(fresh_name("other"))).alias("elsewhere"),
        "n_rows",
    )


@query
def row_count_metric(spark, sf_dir):
    """Row count taken while the rows pass on to a sink."""
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    rows, seen = counted(keys, fresh_name("rows"))
    rows.write.format("noop").mode("overwrite").save()
    return spark.range(1).select(F.lit(seen.get["rows"]).cast("long").alias("n_rows"))


@query
def audit_clock(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id", local_wall_clock(F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("local_ts")
    )


# --- projections, casts, filters -------------------------------------------------------


@query
def typed_projection(spark, sf_dir):
    text = text_columns(table(spark, sf_dir, "lineitem"))
    return text.select(
        F.col("l_orderkey").cast("long"),
        F.col("l_linenumber").cast("int"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("shipped"),
        F.col("l_quantity").cast("double").alias("quantity"),
        (F.col("l_linestatus") == "O").cast("string").cast("boolean").alias("is_open"),
    )


@query
def try_cast_tolerant(spark, sf_dir):
    """Sizes of some parts and type names of the others, as integers."""
    part = table(spark, sf_dir, "part")
    mixed = F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_type"))
    return part.select("p_partkey", mixed.try_cast("int").alias("as_int"))


@query
def rename_projection(spark, sf_dir):
    stamped = table(spark, sf_dir, "customer").withColumn("row_num", F.lit(1))
    customers = stamped.drop("row_num").alias("a")
    return rename(
        customers.withColumn("rich", F.col("a.c_acctbal") > 5000),
        {"c_custkey": "id_original_cliente", "a.c_name": "nome_cliente", "rich": "rico"},
    )


@query
def filter_not_null(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return orders.filter(F.col("status").isNotNull()).select("o_orderkey", "status")


@query
def filter_exclude(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.filter(F.col("p_type") != F.lit("PROMO")).select("p_partkey", "p_type")


@query
def filter_compare(spark, sf_dir):
    """Order of texts and equality of integers."""
    orders = table(spark, sf_dir, "orders")
    return orders.filter(
        (F.col("o_orderpriority") > "3") & (F.dayofmonth("o_orderdate") == 1)
    ).select("o_orderkey", "o_orderpriority")


# --- scalar functions ------------------------------------------------------------------


@query
def norm_trim_upper(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.initcap("c_name"), F.lit(" é\t "))
    return table(spark, sf_dir, "customer").select("c_custkey", trim_upper(padded).alias("name"))


@query
def norm_trim_lower(spark, sf_dir):
    padded = F.concat(F.lit(" "), F.col("c_name"), F.lit("@EX.COM  "))
    return table(spark, sf_dir, "customer").select("c_custkey", trim_lower(padded).alias("email"))


def _remarks(spark, sf_dir):
    """Orders with a remark that is null, empty, blank or a text."""
    kind = F.col("o_orderkey") % 4
    remark = (
        F.when(kind == 1, "").when(kind == 2, "   ").when(kind == 3, F.concat(F.lit(" n "), "o_orderpriority"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", remark.alias("remark"))


@query
def default_null_only(spark, sf_dir):
    return _remarks(spark, sf_dir).select("o_orderkey", null_to_upper("remark", "não").alias("remark"))


@query
def default_blank_only(spark, sf_dir):
    return _remarks(spark, sf_dir).select("o_orderkey", blank_to("remark", "não").alias("remark"))


@query
def default_null_or_blank(spark, sf_dir):
    return _remarks(spark, sf_dir).select(
        "o_orderkey",
        empty_to("remark", "não").alias("as_is"),
        empty_to_upper("remark", "não").alias("upper"),
    )


@query
def zero_fill_(spark, sf_dir):
    balance = F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal"))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        zero_fill(balance.cast("decimal(10,2)")).alias("as_decimal"),
        zero_fill(balance).alias("as_double"),
        zero_fill(F.nullif("s_nationkey", F.lit(7))).alias("as_int"),
    )


@query
def empty_list_default(spark, sf_dir):
    kind = F.col("event_id") % 4
    options = F.when(kind == 0, "[]").when(kind == 1, "").when(kind == 2, F.col("props"))
    return table(spark, sf_dir, "events").select(
        "event_id", empty_list_to(options, "NÃO INFORMADO").alias("options")
    )


def _units(spark, sf_dir):
    return frames.bronze(spark, sf_dir, "units").select("unitId", "address", "stateId").distinct()


@query
def state_from_address(spark, sf_dir):
    return _units(spark, sf_dir).select("unitId", state_code("address").alias("state"))


@query
def fallback_state(spark, sf_dir):
    return _units(spark, sf_dir).select("unitId", state_or_extracted("stateId", "address").alias("state"))


@query
def postal_code_(spark, sf_dir):
    return _units(spark, sf_dir).select("unitId", postal_code("address").alias("zip"))


@query
def digits_only_(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", digits_only("c_name").alias("digits"))


@query
def surrogate_key_(spark, sf_dir):
    """Key of a number, of a text, and of a null for some orders."""
    some = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        surrogate_key("o_orderkey").alias("sk_order"),
        surrogate_key("o_orderpriority").alias("sk_priority"),
        surrogate_key(some).alias("sk_customer"),
    )


@query
def status_decode(spark, sf_dir):
    code = F.nullif(F.col("o_orderkey") % 9, F.lit(8)).cast("int")
    return table(spark, sf_dir, "orders").select("o_orderkey", status_label(code).alias("label"))


@query
def platform_decode(spark, sf_dir):
    kind = F.col("c_custkey") % 6
    code = F.when(kind == 5, "web").when(kind != 0, kind.cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", platform_label(code).alias("label"))


@query
def soft_delete_flag(spark, sf_dir):
    deleted = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        deletion_label(deleted).alias("masculine"),
        deletion_label(deleted, "Ativa", "Inativa").alias("feminine"),
    )


@query
def bool_label(spark, sf_dir):
    flag = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "O")
    return table(spark, sf_dir, "orders").select("o_orderkey", yes_no(flag).alias("label"))


# --- distinct, dedup, joins ------------------------------------------------------------


@query
def distinct_column(spark, sf_dir):
    return distinct_values(table(spark, sf_dir, "orders"), "o_custkey")


@query
def distinct_rows(spark, sf_dir):
    return distinct_values(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query
def dedup_any_key(spark, sf_dir):
    """Which row survives is open, so only the keys are compared."""
    return any_by_key(table(spark, sf_dir, "events"), "user_id").select("user_id")


@query
def latest_by_key_(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_by_key(events, "user_id", "ts")


@query
def latest_with_nulls_and_ties(spark, sf_dir):
    """Versions that are null or equal, and a null key."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.nullif("l_suppkey", F.lit(3)).alias("supplier"),
        F.when(F.col("l_linenumber") != 2, F.col("l_quantity")).alias("quantity"),
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
    )
    return latest_by_key(lines, "supplier", "quantity")


@query
def join_inner_using(spark, sf_dir):
    """Newest order per customer, with customers under twice their key: half find none."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    newest = latest_by_key(orders, "o_custkey", "o_orderdate").withColumnRenamed("o_custkey", "c_custkey")
    customers = table(spark, sf_dir, "customer").withColumn("c_custkey", 2 * F.col("c_custkey"))
    return newest.alias("a").join(customers.alias("b"), on="c_custkey", how="inner").select(
        "c_custkey", F.col("a.o_orderkey").alias("o_orderkey"), F.col("b.c_name").alias("c_name")
    )


@query
def join_star_left(spark, sf_dir):
    """Orders with five dimensions, one row each, null where the key is null."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_custkey", F.lit(7)).alias("cust"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        "o_orderpriority",
        (F.col("o_orderkey") % 30).cast("int").alias("nation"),
        (F.col("o_orderkey") % 7).cast("int").alias("region"),
    )
    base = table(spark, sf_dir, "orders")

    def keyed(df, column, sk):
        return df.select(column, surrogate_key(column).alias(sk))

    def codes(column, sk):
        return materialize(keyed(distinct_values(base, column), column, sk), sk)

    dims = {
        "customer": keyed(table(spark, sf_dir, "customer"), "c_custkey", "sk_cust"),
        "status": codes("o_orderstatus", "sk_status"),
        "priority": codes("o_orderpriority", "sk_priority").withColumnRenamed("o_orderpriority", "prio"),
        "nation": keyed(table(spark, sf_dir, "nation"), "n_nationkey", "sk_nation"),
        "region": keyed(table(spark, sf_dir, "region"), "r_regionkey", "sk_region"),
    }
    links = [
        DimensionLink("customer", "cust", "c_custkey", "sk_cust"),
        DimensionLink("status", "status", "o_orderstatus", "sk_status"),
        DimensionLink("priority", "o_orderpriority", "prio", "sk_priority"),
        DimensionLink("nation", "nation", "n_nationkey", "sk_nation"),
        DimensionLink("region", "region", "r_regionkey", "sk_region"),
    ]
    return link_dimensions(orders, links, dims)


@query
def join_detail_left(spark, sf_dir):
    """Lines with part, supplier and order; the second line of an order is an orphan."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 2, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        "l_linenumber", "l_partkey", "l_quantity",
        F.when(F.col("l_linenumber") != 3, F.col("l_suppkey")).alias("supp"),
    )
    dims = {
        "part": table(spark, sf_dir, "part").select("p_partkey", surrogate_key("p_partkey").alias("sk_part")),
        "supplier": table(spark, sf_dir, "supplier").select(
            "s_suppkey", surrogate_key("s_suppkey").alias("sk_supp")
        ),
        "orders": table(spark, sf_dir, "orders").select(
            "o_orderkey", surrogate_key("o_orderkey").alias("sk_order")
        ),
    }
    links = [
        DimensionLink("part", "l_partkey", "p_partkey", "sk_part"),
        DimensionLink("supplier", "supp", "s_suppkey", "sk_supp"),
        DimensionLink("orders", "l_orderkey", "o_orderkey", "sk_order"),
    ]
    return link_dimensions(lines, links, dims)


@query
def fanout_guard_(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id")
    )
    return fanout_guard(lines, "line_id")


@query
def surrogate_collisions(spark, sf_dir):
    """Keys of order lines that crc32 cannot tell apart."""
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id")
    )
    return key_collisions(lines, "line_id")


@query
def surrogate_key_map(spark, sf_dir):
    """Order lines registered in two batches; no two of them share a key."""
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"), "l_linenumber"
    )
    registry = fresh_name("keys")
    root = shared_path(spark, "keys")
    register_keys(spark, registry, root, lines.where("l_linenumber > 3"), "line_id")
    register_keys(spark, registry, root, lines, "line_id")
    keyed = with_registered_key(lines.select("line_id").distinct(), "line_id", scanned(spark, registry), "surrogate")
    shared = keyed.groupBy("surrogate").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not shared.isEmpty():
        raise AssertionError("a surrogate key is shared")
    return keyed


# --- Bronze tables ---------------------------------------------------------------------


#: Records per landed file. Compressed files are read whole by one task each.
FILE_RECORDS = 200_000


def _write_pages(envelopes, path, page_rows=frames.PAGE_ROWS, mode="error"):
    """Land envelopes of up to ``page_rows`` records as compressed text, in files of bounded size."""
    writer = envelopes.select(text_of(envelopes.columns)).write.mode(mode)
    writer.option("maxRecordsPerFile", FILE_RECORDS // page_rows).text(path, compression="gzip")


def _land(spark, envelopes, name):
    path = shared_path(spark, name)
    _write_pages(envelopes, path, 1 if ENTITIES[name].parent else frames.PAGE_ROWS)
    return path


def loaded_bronze(
    spark: SparkSession, entity: str, landings: list[DataFrame], modes: list[str]
) -> DataFrame:
    """The Bronze table of an entity after one load per landing; its audit column is dropped."""
    lake = Lakehouse(
        bronze="default", prefix=f"{fresh_name('load')}_", location=shared_path(spark, "lake")
    )
    found = [run_bronze(spark, lake, entity, _land(spark, df, entity)).mode for df in landings]
    if found != modes:
        raise AssertionError(f"unexpected load modes {found}")
    return without_stamp(scanned(spark, lake.table("bronze", entity)))


def landed_bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """An entity landed as pages of JSON lines and loaded by its job."""
    source = frames.bronze(spark, sf_dir, entity)
    rows = loaded_bronze(spark, entity, [pages(source, source.columns)], [FULL])
    return rows.select(*SILVER[entity].types)


@query
def bronze_paged(spark, sf_dir):
    return landed_bronze(spark, sf_dir, "evaluations")


for _entity in ("checklists", "categories", "items", "units", "users", "user_types"):
    QUERIES[f"bronze_paged_{_entity}"] = functools.partial(landed_bronze, entity=_entity)


@query
def bronze_incremental(spark, sf_dir):
    """Two loads of users: the first version in full, the second past the watermark.

    Every seventh user's second version has no watermark value and is loaded all the same.
    """
    users = frames.bronze(spark, sf_dir, "users")
    second = F.col("name").endswith("Ação ")
    undated = users.filter(second).withColumn(
        "updatedAt", F.when(F.col("userId").cast("long") % 7 != 0, F.col("updatedAt"))
    )
    landings = [pages(v, users.columns) for v in (users.filter(~second), undated)]
    return loaded_bronze(spark, "users", landings, [FULL, INCREMENTAL]).select(*users.columns)


@query
def bronze_incremental_results(spark, sf_dir):
    """Results loaded twice: a second load of the same rows brings back the unanswered ones."""
    spec = SILVER["evaluations_results"]
    source = frames.bronze(spark, sf_dir, spec.name)
    landing = child_pages(source, [c for c in spec.types if c != spec.parent], spec.parent)
    rows = loaded_bronze(spark, spec.name, [landing, landing], [FULL, INCREMENTAL])
    return rows.select("resultId", "evaluationId", "answeredAt")


@query
def bronze_children(spark, sf_dir):
    """Results landed as pages of their evaluations and stamped with its id."""
    spec = SILVER["evaluations_results"]
    source = frames.bronze(spark, sf_dir, spec.name)
    landing = child_pages(source, [c for c in spec.types if c != spec.parent], spec.parent)
    return loaded_bronze(spark, spec.name, [landing], [FULL]).select(*spec.types)


@query
def bronze_extra_fields(spark, sf_dir):
    """User types whose watermark is spelled otherwise, with a field nobody declared, and nulls."""
    customers = table(spark, sf_dir, "customer")
    record = F.struct(
        F.col("c_custkey").alias("userTypeId"),
        F.col("c_name").alias("name"),
        F.lit("2024-01-01 00:00:00").alias("UpdatedAt"),
        F.col("c_mktsegment").alias("segment"),
    )
    landing = customers.select(
        F.array(record, F.when(F.lit(False), record)).alias("data"),
        F.struct(F.lit(False).alias("hasMore")).alias("meta"),
    )
    payloads = landing.select(F.to_json(F.struct("data", "meta"), {"ignoreNullFields": "false"}))
    path = shared_path(spark, "extra")
    payloads.write.text(path)
    lake = Lakehouse(
        bronze="default", prefix=f"{fresh_name('extra')}_", location=shared_path(spark, "lake")
    )
    run_bronze(spark, lake, "user_types", path)
    rows = scanned(spark, lake.table("bronze", "user_types"))
    return rows.select("userTypeId", "name", "updatedAt", F.col(OTHER)["segment"].alias("segment"))


@query
def bronze_manifest(spark, sf_dir):
    """Users landed three times in one folder; every load reads the files that came since."""
    users = frames.bronze(spark, sf_dir, "users")
    second, even = F.col("name").endswith("Ação "), F.col("userId").cast("long") % 2 == 0
    lake = Lakehouse(bronze="default", prefix=f"{fresh_name('load')}_", location=shared_path(spark, "lake"))
    landing, reports = shared_path(spark, "users"), []
    for part in (~second, second & even, second & ~even):
        envelopes = pages(users.filter(part), users.columns)
        _write_pages(envelopes, landing, mode="append")
        reports.append(run_bronze(spark, lake, "users", landing))
    reports.append(run_bronze(spark, lake, "users", landing))
    if [r.mode for r in reports] != [FULL, INCREMENTAL, INCREMENTAL, None]:
        raise AssertionError(f"unexpected loads {reports}")
    return scanned(spark, lake.table("bronze", "users")).select("userId", "name", "updatedAt")


@query
def bronze_quarantine(spark, sf_dir):
    """One customer per page; every seventh page was cut off and is put aside."""
    customers = table(spark, sf_dir, "customer")
    record = F.struct(F.col("c_custkey").alias("userTypeId"), F.col("c_name").alias("name"))
    page = F.to_json(F.struct(F.array(record).alias("data"), F.struct(F.lit(True).alias("hasMore")).alias("meta")))
    cut = F.when(F.col("c_custkey") % 7 == 0, F.substr(page, F.lit(1), F.length(page) - 3)).otherwise(page)
    landing = shared_path(spark, "cut")
    customers.select(cut).write.text(landing)
    lake = Lakehouse(bronze="default", prefix=f"{fresh_name('load')}_", location=shared_path(spark, "lake"))
    report = run_bronze(spark, lake, "user_types", landing, quarantine=True)
    rejected = scanned(spark, lake.table("bronze", "user_types_rejected"))
    rows = scanned(spark, lake.table("bronze", "user_types"))
    return (
        rows.select("userTypeId", F.lit("loaded").alias("found"))
        .unionByName(
            rejected.select(
                F.regexp_extract("page", r'"userTypeId":(\d+)', 1).alias("userTypeId"), F.lit("rejected").alias("found")
            )
        )
        .withColumn("n_rejected", F.lit(report.rejected).cast("long"))
    )


@query
def page_gaps_(spark, sf_dir):
    """Order numbers as pages: the runs of numbers that each status lacks."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("page"))
    return page_gaps(orders, ["status"], block=1000)


def superseded(spark: SparkSession, entity: str, source: DataFrame) -> DataFrame:
    """An undeclared entity after a load: its records are maps, here shown by column."""
    rows = loaded_bronze(spark, entity, [pages(source, source.columns)], [FULL])
    return project_records(rows, source.columns)


@query
def bronze_superseded(spark, sf_dir):
    """History records."""
    source = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("evaluationId"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("string")).alias("date"),
    )
    return superseded(spark, "evaluations_history", source)


@query
def bronze_superseded_countries(spark, sf_dir):
    source = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("countryId"), F.col("n_name").alias("name")
    )
    return superseded(spark, "countries", source)


@query
def bronze_superseded_departments(spark, sf_dir):
    source = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("departmentId"),
        F.col("o_orderdate").cast("string").alias("date"),
    )
    return superseded(spark, "evaluations_departments", source)


@query
def bronze_stream(spark, sf_dir):
    """Items drained by an available-now stream in place of a watermark load."""
    spec = SILVER["items"]
    source = frames.bronze(spark, sf_dir, "items")
    landing = _land(spark, pages(source, source.columns), "items")
    target = shared_path(spark, "items_bronze")
    stream_bronze(spark, spec, landing, shared_path(spark, "items_state"), path=target).awaitTermination()
    return without_stamp(spark.read.parquet(target)).select(*spec.types)


# --- Silver and Gold tables ------------------------------------------------------------


def silver(spark: SparkSession, sf_dir: str, entity: str, row_key: str | None = None) -> DataFrame:
    return conform(frames.bronze(spark, sf_dir, entity), SILVER[entity], row_key=row_key)


def gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Gold table. What a fact links to is written first, as the jobs do.

    Of a linked table only the two columns that links read are written.
    """
    if name not in FACTS:
        return build_gold(name, functools.partial(silver, spark, sf_dir), stored_nowhere)
    links = {link.dimension: link for fact in FACTS.values() for link in fact.links}
    stored: dict[str, DataFrame] = {}

    def stored_silver(entity: str) -> DataFrame:
        return stored[entity] if entity in stored else silver(spark, sf_dir, entity)

    def store(table_name: str) -> None:
        if table_name in SILVER:
            built = silver(spark, sf_dir, table_name)
        else:
            link = links[table_name]
            built = build_gold(table_name, stored_silver, stored.__getitem__)
            built = built.select(link.natural, link.surrogate)
        stored[table_name] = materialize(built, table_name)

    facts = sorted(linked_tables(name) & FACTS.keys())
    dims = sorted({dim for fact in (name, *facts) for dim in linked_tables(fact)} - FACTS.keys())
    late = [dim for dim in dims if DIMENSIONS[dim].source == "evaluations"]
    in_parallel(store, ["evaluations", *[dim for dim in dims if dim not in late]])
    in_parallel(store, late)
    in_parallel(store, facts)

    def fact_rows(entity: str) -> DataFrame:
        return stored[entity] if entity in stored else silver(spark, sf_dir, entity, ROW_KEY)

    return build_gold(name, fact_rows, stored.__getitem__)


def stored_nowhere(name: str) -> DataFrame:
    raise LookupError(f"a dimension does not read {name}")


for _entity in SILVER:
    QUERIES[f"silver_{_entity}"] = functools.partial(
        lambda spark, sf_dir, entity: as_wall_clock(silver(spark, sf_dir, entity)), entity=_entity
    )

@query
def silver_incremental(spark, sf_dir):
    """Users built from two Bronze loads, the second by the buckets it touches."""
    name = fresh_name("delta")
    for layer in ("bronze", "silver"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS starlode_{layer}")
    lake = Lakehouse("starlode_bronze", "starlode_silver", prefix=f"{name}_", location=shared_path(spark, "lake"))
    users = frames.bronze(spark, sf_dir, "users")
    second = F.col("name").endswith("Ação ")
    modes = []
    for rows in (users.filter(~second), users.filter(second)):
        run_bronze(spark, lake, "users", _land(spark, pages(rows, users.columns), "users"))
        modes.append(run_silver_delta(spark, lake, "users", buckets=16).mode)
    if modes != [FULL, INCREMENTAL]:
        raise AssertionError(f"unexpected load modes {modes}")
    made = materialize(without_stamp(spark.read.table(lake.table("silver", "users"))), "users")
    for layer, entity in (("bronze", "users"), ("silver", "users"), ("silver", "users_versions")):
        spark.sql(f"DROP TABLE {lake.table(layer, entity)}")
    return as_wall_clock(made.drop(BUCKET))


@query
def fact_incremental(spark, sf_dir):
    """The fact of applied checklists from two loads of evaluations and of what they link to."""
    name = fresh_name("facts")
    layers = ("bronze", "silver", "gold")
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS starlode_{layer}")
    lake = Lakehouse(*(f"starlode_{x}" for x in layers), prefix=f"{name}_", location=shared_path(spark, "lake"))
    source = {e: frames.bronze(spark, sf_dir, e) for e in ("evaluations", "checklists", "units", "users", "user_types")}
    late = {  # what the second load brings
        "evaluations": F.col("updatedAt") >= "2021",
        "checklists": F.col("checklistId").cast("long") % 50 == 0,
        "units": F.col("unitId").cast("long") % 2 == 0,
    }
    modes = []
    for second in (False, True):
        for entity, rows in source.items():
            if second and entity not in late:
                continue
            if entity in late:
                part = F.coalesce(late[entity], F.lit(False))
                rows = rows.where(part if second else ~part)
            landing = _land(spark, pages(rows, rows.columns), entity)
            run_bronze(spark, lake, entity, landing, inclusive=True)
            if entity == "evaluations":
                run_silver_delta(spark, lake, entity, buckets=16)
            else:
                run_silver(spark, lake, entity)
        for dim in ("dim_status", "dim_plataforma", "dim_checklists", "dim_unidades", "dim_usuario"):
            run_gold(spark, lake, dim)
        modes.append(run_gold_delta(spark, lake, "fato_checklists_aplicados").mode)
    if modes != [FULL, INCREMENTAL]:
        raise AssertionError(f"unexpected load modes {modes}")
    made = spark.read.table(lake.table("gold", "fato_checklists_aplicados"))
    made = materialize(without_stamp(made).drop(BUCKET), "facts")
    for layer in layers:
        for found in spark.catalog.listTables(f"starlode_{layer}"):
            if found.name.startswith(name):
                spark.sql(f"DROP TABLE starlode_{layer}.{found.name}")
    return as_wall_clock(made)


GOLD_KEYS = {
    "dim_status": "dim_status",
    "dim_plataforma": "dim_plataforma",
    "dim_checklists": "dim_checklists",
    "dim_unidades": "dim_unidades",
    "dim_usuario": "dim_usuario",
    "dim_categorias": "dim_categorias",
    "dim_itens": "dim_itens",
    "fact_applied": "fato_checklists_aplicados",
    "fact_results": "fato_checklists_aplicados_resultados",
}
for _key, _name in GOLD_KEYS.items():
    QUERIES[_key] = functools.partial(
        lambda spark, sf_dir, name: as_wall_clock(gold(spark, sf_dir, name)), name=_name
    )
