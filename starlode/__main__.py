"""Loads from the command line, also as the main file of ``spark-submit``.

    python -m starlode bronze users --landing /data/landing
    python -m starlode silver users
    python -m starlode gold dim_usuario
    python -m starlode all --landing /data/landing
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from starlode.plans import (
    DIMENSIONS,
    ENTITIES,
    FACTS,
    SILVER,
    Lakehouse,
    LoadReport,
    run_all,
    run_bronze,
    run_gold,
    run_silver,
    run_silver_delta,
)
from starlode.plans.jobs import run_gold_delta, stored
from starlode.session import apply_sizing
from starlode.streaming import run_bronze_new_files


def arguments() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--bronze", default="bronze", help="Bronze database")
    common.add_argument("--silver", default="silver", help="Silver database")
    common.add_argument("--gold", default="gold", help="Gold database")
    common.add_argument("--prefix", default="", help="prefix of all table names")
    common.add_argument("--location", help="folder for external tables")

    landing = argparse.ArgumentParser(add_help=False)
    landing.add_argument("--landing", required=True, help="folder with one folder per entity")
    landing.add_argument("--force-full", action="store_true", help="ignore the watermark")
    landing.add_argument("--inclusive", action="store_true", help="also take rows of equal age")
    landing.add_argument(
        "--file-per-envelope", action="store_true", help="one envelope per file, not per line"
    )
    landing.add_argument(
        "--parent-pattern", help="regex on the file path whose first group is the parent's id"
    )

    landing.add_argument(
        "--state", help="folder that remembers read files: load new files only, by no watermark"
    )
    landing.add_argument("--reread", action="store_true", help="read files of earlier loads again")
    landing.add_argument(
        "--quarantine", action="store_true", help="put malformed pages aside instead of failing"
    )
    landing.add_argument("--page-pattern", help="regex on file names whose first group is the page")

    keys = argparse.ArgumentParser(add_help=False)
    keys.add_argument("--key-method", choices=("crc32", "xxhash64"), default="crc32")

    parser = argparse.ArgumentParser(prog="starlode", description=__doc__.splitlines()[0])
    layers = parser.add_subparsers(dest="layer", required=True)
    layers.add_parser("bronze", parents=[common, landing]).add_argument("name", choices=ENTITIES)
    silver = layers.add_parser("silver", parents=[common])
    silver.add_argument("name", choices=SILVER)
    silver.add_argument("--keep", choices=("latest", "any", "all"))
    silver.add_argument("--delta", action="store_true", help="rewrite only what new rows touch")
    gold = layers.add_parser("gold", parents=[common, keys])
    gold.add_argument("name", choices=[*DIMENSIONS, *FACTS])
    gold.add_argument("--delta", action="store_true", help="rewrite only what changes reach (facts)")
    gold.add_argument("--where", help="SQL condition on the Silver rows of a dimension")
    layers.add_parser("all", parents=[common, landing, keys])
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> list[LoadReport]:
    parser = arguments()
    args = parser.parse_args(argv)
    if args.layer == "gold" and args.delta and (args.name not in FACTS or args.where):
        parser.error("--delta is for facts, which take no --where")
    spark = spark or SparkSession.builder.appName("starlode").getOrCreate()
    lake = Lakehouse(args.bronze, args.silver, args.gold, args.prefix, args.location)
    lake.create_databases(spark)
    if args.layer in ("bronze", "all"):
        options = {
            "file_per_envelope": args.file_per_envelope,
            "parent_pattern": args.parent_pattern,
            "quarantine": args.quarantine,
        }
        if args.page_pattern:
            options["page_pattern"] = args.page_pattern
        by_files = {"force_full": args.force_full, "inclusive": args.inclusive, "reread": args.reread}
        if not args.state:
            options |= by_files
        elif any(by_files.values()):
            named = ", ".join(f"--{k.replace('_', '-')}" for k, v in by_files.items() if v)
            parser.error(f"--state loads new files by no watermark; it cannot honour {named}")

    def load(spark: SparkSession, lake: Lakehouse, entity: str, path: str, **options: object) -> LoadReport:
        if not args.state:
            return run_bronze(spark, lake, entity, path, **options)
        state = f"{args.state.rstrip('/')}/{entity}"
        return run_bronze_new_files(spark, lake, entity, path, state, **options)

    if args.layer == "bronze":
        path = f"{args.landing.rstrip('/')}/{args.name}"
        apply_sizing(spark, [spark.read.text(path)])
        reports = [load(spark, lake, args.name, path, **options)]
    elif args.layer == "silver":
        apply_sizing(spark, [spark.read.table(lake.table("bronze", args.name))])
        if args.delta:
            reports = [run_silver_delta(spark, lake, args.name)]
        else:
            reports = [run_silver(spark, lake, args.name, args.keep)]
    elif args.layer == "gold":
        source = (DIMENSIONS | FACTS)[args.name].source
        apply_sizing(spark, [stored(spark, lake.table("silver", source))])
        where = F.expr(args.where) if args.where else None
        if args.delta:
            reports = [run_gold_delta(spark, lake, args.name, args.key_method)]
        else:
            reports = [run_gold(spark, lake, args.name, args.key_method, where=where)]
    else:
        reports = run_all(
            spark, lake, args.landing, method=args.key_method, sized=True, load=load, **options
        )
    for report in reports:
        print(report)
    return reports


if __name__ == "__main__":
    main()
