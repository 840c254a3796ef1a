"""Bronze frames shaped out of the test tables.

All columns are text, as in a Bronze table. Nulls, blanks, orphans and duplicate
versions are put in by arithmetic on the keys; no row of a table is left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlode.plans.entities import SILVER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so that results do not depend on the session zone."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# SELECT list, table and whether each row comes in two versions (v = 0 and 1).
SHAPES = {
    "user_types": (
        """
        cast(s_nationkey AS string) AS userTypeId,
        concat('  type ', s_name, ' ') AS name,
        CASE WHEN s_suppkey % 4 = 0 THEN 'false' ELSE 'true' END AS active,
        '2019-05-01 10:00:00' AS createdAt,
        CASE WHEN s_suppkey % 11 = 0 THEN NULL
             ELSE concat('2020-01-', lpad(cast(1 + s_suppkey % 28 AS string), 2, '0'), ' 08:00:00')
        END AS updatedAt,
        CASE WHEN s_suppkey % 9 = 0 THEN '2021-02-03 04:05:06' END AS deletedAt
        """,
        "supplier",
        False,
    ),
    "users": (
        """
        cast(c_custkey AS string) AS userId,
        concat('  ', c_name, CASE v WHEN 1 THEN ' da Ação ' ELSE ' ' END) AS name,
        concat(' ', c_name, '@EX.Com ') AS email,
        'true' AS active,
        CASE WHEN c_custkey % 13 = 0 THEN NULL
             ELSE cast(c_nationkey + CASE WHEN c_custkey % 7 = v THEN 25 ELSE 0 END AS string)
        END AS userTypeId,
        concat('(11) ', c_name) AS phone,
        cast(c_nationkey % 3 AS string) AS languageId,
        cast(c_nationkey AS string) AS countryId,
        CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE cast(c_custkey % 27 AS string) END AS stateId,
        '2019-06-01 00:00:00' AS createdAt,
        CASE WHEN (c_custkey + v) % 17 = 0 THEN NULL
             ELSE concat('202', cast(v AS string), '-03-',
                         lpad(cast(1 + c_custkey % 28 AS string), 2, '0'), ' 12:30:00')
        END AS updatedAt,
        CASE WHEN c_custkey % 10 = v THEN '2022-01-01 00:00:00' END AS deletedAt
        """,
        "customer",
        True,
    ),
    "units": (
        """
        cast(s_suppkey AS string) AS unitId,
        concat(s_name, ' v', cast(v AS string)) AS name,
        concat(s_name, '@ex.com') AS email,
        'true' AS active,
        cast(s_nationkey AS string) AS unitTypeId,
        '99999-999' AS zipCode,
        CASE s_suppkey % 6
             WHEN 0 THEN NULL
             WHEN 1 THEN 'Rua A 10, Centro'
             WHEN 2 THEN concat('Av. B, Campinas SP CEP: 13010-', lpad(cast(s_suppkey % 1000 AS string), 3, '0'))
             WHEN 3 THEN concat('Largo SE 22 RJ CEP 2004', cast(s_suppkey AS string))
             WHEN 4 THEN 'CEP12345678901 MG'
             ELSE 'ASP 5 sp, CEP : 01310-100 CEP 2'
        END AS address,
        cast(s_suppkey % 900 AS string) AS number,
        CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'sala 3' END AS complement,
        '1' AS countryId,
        CASE WHEN s_suppkey % 7 = 0 THEN 'XX' END AS stateId,
        cast(s_suppkey % 50 AS string) AS cityId,
        '-23.5' AS latitude,
        '-46.25' AS longitude,
        '2019-07-01 00:00:00' AS createdAt,
        concat('202', cast(v AS string), '-04-01 00:00:00') AS updatedAt,
        CASE WHEN s_suppkey % 4 = v THEN '2022-05-06 07:08:09' END AS deletedAt
        """,
        "supplier",
        True,
    ),
    "checklists": (
        """
        cast(p_partkey AS string) AS checklistId,
        p_type AS type,
        concat(' ', p_name, ' ') AS name,
        CASE (p_partkey + v) % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat(p_brand, ' ') END AS subject,
        CASE (p_partkey + v) % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   '
             ELSE concat('descrição ', p_name) END AS description,
        CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END AS active,
        '2019-08-01 00:00:00' AS createdAt,
        concat('2021-0', cast(1 + (p_partkey + v) % 2 AS string), '-01 00:00:00') AS updatedAt,
        CASE WHEN p_partkey % 5 = v THEN '2022-02-02 02:02:02' END AS deletedAt
        """,
        "part",
        True,
    ),
    "categories": (
        """
        cast(s_suppkey AS string) AS categoryId,
        cast(s_suppkey * 3 AS string) AS checklistId,
        CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE cast(s_nationkey AS string) END AS parentId,
        cast(s_suppkey % 3 AS string) AS type,
        concat(' cat ', s_name) AS name,
        CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE s_name END AS description,
        '2019-09-01 00:00:00' AS createdAt,
        '2020-09-01 00:00:00' AS updatedAt,
        CAST(NULL AS string) AS deletedAt
        """,
        "supplier",
        False,
    ),
    "items": (
        """
        cast(p_partkey AS string) AS itemId,
        cast(p_partkey % 1000 AS string) AS checklistId,
        cast(p_size AS string) AS categoryId,
        concat(' ', p_name) AS name,
        CASE WHEN p_partkey % 6 = 0 THEN '2022-03-03 03:03:03' END AS deletedAt,
        cast(p_size AS string) AS order
        """,
        "part",
        False,
    ),
    "evaluations": (
        """
        cast(o_orderkey AS string) AS evaluationId,
        CASE WHEN (o_orderkey + v) % 9 = 8 THEN NULL ELSE cast((o_orderkey + v) % 9 AS string) END AS status,
        CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE cast(o_totalprice AS string) END AS score,
        cast(o_orderkey % 2500 AS string) AS checklistId,
        cast(o_orderkey % 120 AS string) AS unitId,
        cast(o_custkey AS string) AS userId,
        cast(o_orderdate AS string) AS startedAt,
        CASE WHEN o_orderstatus = 'F' THEN cast(o_orderdate AS string) END AS concludedAt,
        CAST(NULL AS string) AS approvedAt,
        CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 5 THEN 'web' ELSE cast(o_orderkey % 6 AS string) END AS platform,
        CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'true' ELSE 'false' END AS scheduled,
        cast(o_orderdate AS string) AS scheduleStartDate,
        CAST(NULL AS string) AS scheduleEndDate,
        CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   '
             ELSE concat(' ok ', o_orderpriority) END AS finalComment,
        CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END AS sharedTo,
        cast(o_orderkey % 4 AS string) AS countAttachments,
        '-23.5' AS initialLatitude,
        '-46.25' AS initialLongitude,
        CAST(NULL AS string) AS finalLatitude,
        CAST(NULL AS string) AS finalLongitude,
        cast(o_orderdate AS string) AS createdAt,
        CASE WHEN (o_orderkey + v) % 7 = 0 THEN NULL
             ELSE concat('202', cast(v AS string), '-05-05 05:05:05') END AS updatedAt,
        CAST(NULL AS string) AS deletedAt
        """,
        "orders",
        True,
    ),
    "evaluations_results": (
        """
        cast(l_orderkey * 10 + l_linenumber AS string) AS resultId,
        cast(l_orderkey AS string) AS evaluationId,
        cast(l_suppkey + CASE WHEN l_orderkey % 10 = 0 THEN 900000000 ELSE 0 END AS string) AS categoryId,
        CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE cast(l_partkey AS string) END AS itemId,
        cast(l_linenumber AS string) AS scaleId,
        CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(l_shipdate AS string) END AS answeredAt,
        CASE l_linenumber % 3 WHEN 0 THEN 'true' WHEN 1 THEN '1' END AS evaluative,
        CASE l_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE l_returnflag END AS sharedTo,
        CASE l_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('resposta ', l_linestatus) END AS text,
        CASE WHEN l_partkey % 2 = 0 THEN NULL ELSE cast(l_quantity AS string) END AS number,
        cast(l_suppkey % 27 AS string) AS stateId,
        cast(l_suppkey % 50 AS string) AS cityId,
        l_linestatus AS product,
        CAST(NULL AS string) AS competencePeriodId,
        CASE l_partkey % 4 WHEN 0 THEN '[]' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE '["a"]' END AS selectedOptions,
        CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE cast(l_linenumber AS string) END AS index,
        cast(l_extendedprice AS string) AS originalWeight,
        CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE cast(l_discount AS string) END AS maximumWeight,
        cast(l_tax AS string) AS obtainedWeight,
        CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '  Nota ' END AS comment,
        CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE '2' END AS countAttachments,
        CAST(NULL AS string) AS countSignatures,
        cast(l_linenumber AS string) AS itemOrder,
        cast(l_suppkey % 9 AS string) AS categoryOrder
        """,
        "lineitem",
        False,
    ),
}


def bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The Bronze frame of ``entity``."""
    select, source, versions = SHAPES[entity]
    df = table(spark, sf_dir, source)
    if versions:
        df = df.withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    return spark.sql(f"SELECT {select} FROM {{df}}", df=df).select(*SILVER[entity].types)


#: Records per page, as the interface gives them.
PAGE_ROWS = 100


def pages(records: DataFrame, columns: Sequence[str], page_rows: int = PAGE_ROWS) -> DataFrame:
    """Envelopes of at most ``page_rows`` records and an empty last one.

    Pages are cut from runs of rows inside a partition, so their size is bounded
    whatever the rows hold, and no row is shuffled.
    """
    rows = records.select(*columns)
    data = T.StructField("data", T.ArrayType(rows.schema, False))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = pa.array([*range(0, batch.num_rows, page_rows), batch.num_rows], pa.int32())
            if batch.num_rows:
                items = pa.StructArray.from_arrays(batch.columns, names=batch.schema.names)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(bounds, items)], ["data"])

    packed = rows.mapInArrow(cut, T.StructType([data])).select(
        "data", F.struct(F.lit(True).alias("hasMore")).alias("meta")
    )
    closing = records.sparkSession.range(1).select(
        F.array().cast(packed.schema["data"].dataType).alias("data"),
        F.struct(F.lit(False).alias("hasMore")).alias("meta"),
    )
    return packed.unionByName(closing)


def child_pages(records: DataFrame, columns: Sequence[str], parent: str) -> DataFrame:
    """Envelopes that carry the key of their parent, one record each."""
    return records.select(
        parent,
        F.array(F.struct(*columns)).alias("data"),
        F.struct(F.lit(False).alias("hasMore")).alias("meta"),
    )


def text_of(envelope_columns: Sequence[str] = ("data", "meta")) -> Column:
    return F.to_json(F.struct(*envelope_columns))
