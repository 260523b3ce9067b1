"""Files on whatever file system Spark writes to, so that artifacts lie together on a cluster too."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, for processes that don't know the session's default."""
    target, system = _system(spark, path)
    return re.sub("^file:/+", "file:///", system.makeQualified(target).toString())


def write_text(spark: SparkSession, path: str, parts: str | Iterable[str]) -> None:
    """One file with these parts, written by the driver as they come."""
    target, system = _system(spark, path)
    out = system.create(target, True)
    try:
        for part in [parts] if isinstance(parts, str) else parts:
            out.write(part.encode("utf-8"))
    finally:
        out.close()


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _system(spark, path)
    return system.exists(target)
