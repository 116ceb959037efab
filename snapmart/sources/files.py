"""Small file-system helpers that work on any storage Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, and the folders above it."""
    fs, target = _locate(spark, path)
    fs.create(target, True).close()


def modified(spark: SparkSession, path: str) -> float:
    """Time of the last change, in seconds since 1970."""
    fs, target = _locate(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _locate(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
