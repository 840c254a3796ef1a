"""Session settings for small tests and for large clusters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

MIB = 1 << 20


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings that follow the volume of a job.

    Shuffles start with about 256 MiB per partition, at least two per core, and AQE merges
    what turns out small. Scan splits and the size up to which tables are broadcast are the
    same for every volume.
    """
    return {
        "spark.sql.autoBroadcastJoinThreshold": str(10 * MIB),
        "spark.sql.files.maxPartitionBytes": str(256 * MIB),
        "spark.sql.shuffle.partitions": str(max(2 * cores, -(-input_bytes // (256 * MIB)))),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def input_bytes(df: DataFrame) -> int:
    """What Spark expects ``df`` to read, from file sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def apply_sizing(spark: SparkSession, sources: Iterable[DataFrame]) -> None:
    """Size the session for jobs over ``sources``; what was set at its start stays."""
    size = sum(map(input_bytes, sources))
    given = spark.sparkContext.getConf()
    for key, value in sizing(size, spark.sparkContext.defaultParallelism).items():
        if not given.contains(key):
            spark.conf.set(key, value)


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starlode")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
