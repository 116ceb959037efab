"""Typed flat rows out of raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.functions import partition_parts, positive_ratio
from snapmart.schemas import RECORD_COLUMNS


def _typed(value: Column, kind: str) -> Column:
    """Safe cast: a malformed value becomes NULL."""
    if kind == "string":
        return value
    if kind == "timestamp":
        return F.try_to_timestamp(value)
    if kind == "bigint":
        # Whole numbers may arrive written with a fraction, such as 3.0.
        return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))
    return value.try_cast(kind)


def flatten_records(df: DataFrame) -> DataFrame:
    """(ingestion_id, batch_ingested_at, coin) to one typed column per field."""
    return df.select(
        "ingestion_id",
        F.try_to_timestamp(F.col("batch_ingested_at")).alias("batch_ingested_at"),
        *[_typed(F.col(f"coin.{source}"), kind).alias(name) for name, source, kind in RECORD_COLUMNS],
    )


def derive_measures(df: DataFrame) -> DataFrame:
    """Price range, volume share of market cap and direction flag."""
    return df.withColumns({
        "price_range_24h": F.col("high_24h") - F.col("low_24h"),
        "volume_to_market_cap_ratio": positive_ratio(F.col("total_volume"), F.col("market_cap")),
        "is_bullish_24h": F.col("price_change_pct_24h") > 0,
    })


def add_partition_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(partition_parts(F.col("batch_ingested_at")))


def flatten_and_cast(df: DataFrame) -> DataFrame:
    """Raw records to the silver columns."""
    return df.transform(flatten_records).transform(derive_measures).transform(add_partition_columns)


def validity(reject_nan: bool = False) -> Column:
    """True for rows that pass the sanity rules, never NULL."""
    price = F.col("current_price")
    rule = (
        F.col("coin_id").isNotNull() & F.col("symbol").isNotNull()
        & F.col("market_cap").isNotNull() & F.coalesce(price > 0, F.lit(False))
    )
    if reject_nan:
        rule = rule & ~F.isnan(price) & ~F.isnan("market_cap")
    return rule


def keep_valid(df: DataFrame, reject_nan: bool = False) -> DataFrame:
    return df.filter(validity(reject_nan))


def rejected(df: DataFrame, reject_nan: bool = False) -> DataFrame:
    """The rows :func:`keep_valid` drops."""
    return df.filter(~validity(reject_nan))
