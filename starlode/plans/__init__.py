"""Entities, star schema and the jobs that build them."""

from starlode.plans.entities import ENTITIES, SILVER
from starlode.plans.jobs import run_all, run_bronze, run_gold, run_gold_delta, run_silver, run_silver_delta
from starlode.plans.lakehouse import Lakehouse, LoadReport
from starlode.plans.star_schema import DIMENSIONS, FACTS, build_gold

__all__ = [
    "DIMENSIONS",
    "ENTITIES",
    "FACTS",
    "Lakehouse",
    "LoadReport",
    "SILVER",
    "build_gold",
    "run_all",
    "run_bronze",
    "run_gold",
    "run_gold_delta",
    "run_silver",
    "run_silver_delta",
]
