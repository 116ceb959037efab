"""Rows of the newest batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def newest_time(df: DataFrame, ts: str = "batch_ingested_at") -> Column:
    """The largest ``ts``, as a value to compare other columns with."""
    return df.select(ts).agg(F.max(ts)).scalar()


def latest_batch(df: DataFrame, ts: str = "batch_ingested_at") -> DataFrame:
    """Keep rows whose ``ts`` is the maximum.

    Of a stored fact, pass :meth:`GoldStore.newest_fact`, which is one day's folder.
    """
    return df.filter(F.col(ts) == newest_time(df, ts))
