"""Work folder every executor can reach."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="starlode-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A path nobody used yet below ``spark.checkpoint.dir``.

    Only a local session may leave the setting out; on a cluster a folder of the
    driver's machine would be lost to the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = _local_folder()
    return f"{folder.rstrip('/')}/starlode/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage on storage that outlives executors, and gives Catalyst the real
    size, so that a later join broadcasts it only if it is small.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
