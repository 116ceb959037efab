"""Silver layer: flat typed Parquet in year/month/day/hour folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapmart.functions.temporal import hour_number
from snapmart.schemas import PARTITION_COLUMNS, silver_schema
from snapmart.session import materialised, require_utc
from snapmart.sources.files import exists
from snapmart.sources.key_table import BUCKETS, KeyTable


def _laid_out(df: DataFrame) -> DataFrame:
    # Rebalancing gathers each hour into few files, and adaptive execution splits
    # an hour that is too large for one task.
    return df.hint("rebalance", *PARTITION_COLUMNS)


def _written(df: DataFrame, path: str, mode: str, touched_partitions_only: bool = False) -> None:
    require_utc(df.sparkSession)
    writer = _laid_out(df).write.mode(mode).partitionBy(*PARTITION_COLUMNS)
    if touched_partitions_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_silver(df: DataFrame, path: str, mode: str = "overwrite",
                 touched_partitions_only: bool = False) -> None:
    """Write silver; ``touched_partitions_only`` replaces just the hours present in ``df``.

    An index of stored keys that :func:`append_silver` has left there no longer holds and
    is dropped; the next append builds it anew.
    """
    silver_keys(df.sparkSession, path).forget()
    _written(df, path, mode, touched_partitions_only)


def silver_keys(spark: SparkSession, path: str, keys=("ingestion_id", "coin_id"), buckets: int = BUCKETS) -> KeyTable:
    """The stored keys of the silver table at ``path``."""
    return KeyTable(spark, path, keys, lambda: read_silver(spark, path), buckets)


def read_silver(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """Read silver, optionally only batches in ``[since, until)``.

    The bounds also restrict the partition columns, so other folders are not listed
    into the scan.
    """
    df = spark.read.schema(silver_schema()).parquet(path)
    stamp = F.col("batch_ingested_at")
    if since is not None:
        bound = F.lit(since).cast("timestamp")
        df = df.filter((stamp >= bound) & (_folder_hour() >= hour_number(bound)))
    if until is not None:
        bound = F.lit(until).cast("timestamp")
        df = df.filter((stamp < bound) & (_folder_hour() <= hour_number(bound)))
    return df


def _folder_hour():
    y, m, d, h = (F.col(c) for c in PARTITION_COLUMNS)
    return ((y * 100 + m) * 100 + d) * 100 + h


def append_silver(df: DataFrame, path: str, keys=("ingestion_id", "coin_id"), buckets: int = BUCKETS) -> None:
    """Append the rows whose key is not stored yet, so a repeated run adds nothing.

    A snapshot is found under whatever batch time it was stored, or none. Stored keys are
    read from the buckets that ``df`` touches only (see :class:`KeyTable`). A NULL in a
    key is a value like any other.
    """
    spark = df.sparkSession
    require_utc(spark)
    with materialised(df, "append") as rows:
        if not exists(spark, path):
            _written(rows, path, "append")
            return
        stored = silver_keys(spark, path, keys, buckets)
        with materialised(stored.absent(rows), "absent") as absent:
            if not absent.isEmpty():
                with stored.adding(absent):
                    _written(absent, path, "append")
