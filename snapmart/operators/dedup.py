"""One row per key: the latest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def _ranked_columns(df: DataFrame, order: Sequence[str]) -> list:
    # Rows that tie on the order columns are told apart by their contents, so the
    # same row wins on every run.
    return [F.col(c).desc_nulls_last() for c in order] + [F.xxhash64(*df.columns).desc()]


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row that is last by ``order``; NULL keys form one group.

    Spark limits each group before the shuffle, so a key with many rows reaches its
    task as one row per map task.
    """
    latest = Window.partitionBy(*keys).orderBy(*_ranked_columns(df, order))
    return df.withColumn("_position", F.row_number().over(latest)).filter("_position = 1").drop("_position")


def keep_latest_by_aggregate(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Same result as :func:`keep_latest`, by a partial aggregation instead of a window."""
    rest = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(*order, F.xxhash64(*df.columns)))
    return df.groupBy(*keys).agg(latest.alias("_latest")).select(
        *[F.col(c) if c in keys else F.col(f"_latest.{c}").alias(c) for c in df.columns])


def drop_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep any one row per key."""
    return df.dropDuplicates(list(keys))
