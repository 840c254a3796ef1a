"""Folders of a table: listing, atomic renames and small records, on any Hadoop file system."""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str) -> Any:
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    folder = _path(spark, path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _system(spark, path)
    return system.exists(folder)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, folder = _system(spark, path)
    return system.exists(folder) and system.getFileStatus(folder).isDirectory()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    system, folder = _system(spark, path)
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def remove(spark: SparkSession, path: str) -> None:
    system, folder = _system(spark, path)
    system.delete(folder, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as the catalog shows it."""
    system, folder = _system(spark, path)
    return system.makeQualified(folder).toString().rstrip("/")


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename ``source`` to ``target`` in one step; False, and no change, if that exists."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    fs = jvm.org.apache.hadoop.fs
    start, end = _path(spark, source), _path(spark, target)
    system = end.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(end.getParent())
    context = fs.FileContext.getFileContext(end.getParent().toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(start, end, gateway.new_array(fs.Options.Rename, 0))
    except Py4JJavaError as failed:
        if system.exists(end) and system.exists(start):
            return False
        raise failed
    return True


def write_record(spark: SparkSession, path: str, record: dict[str, Any]) -> bool:
    """Put a small record at ``path``, whole or not at all; False if there is one already."""
    system, target = _system(spark, path)
    draft = f"{path}.{uuid.uuid4().hex}"
    out = system.create(_path(spark, draft), False)
    try:
        out.write(bytearray(json.dumps(record).encode()))
    finally:
        out.close()
    if move(spark, draft, path):
        return True
    remove(spark, draft)
    return False


def read_record(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The record at ``path``; None if there is none."""
    system, file = _system(spark, path)
    if not system.exists(file):
        return None
    stream = system.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
