"""One local session for all tests."""

from __future__ import annotations

import os
import sys
import uuid

import pytest

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starlode.plans import Lakehouse  # noqa: E402
from starlode.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        4,
        **{
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    """Three databases of their own."""
    tag = uuid.uuid4().hex[:12]
    made = Lakehouse(f"bronze_{tag}", f"silver_{tag}", f"gold_{tag}")
    made.create_databases(spark)
    return made


def plan_text(df) -> str:
    """The physical plan; the final one if the query has run."""
    return df._jdf.queryExecution().executedPlan().toString()
