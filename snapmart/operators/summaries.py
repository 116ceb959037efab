"""Summaries of a silver table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from snapmart.functions import change_bucket, change_bucket_index
from snapmart.operators.quality import distinct_rows


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def quality_summary(df: DataFrame) -> DataFrame:
    """One row of counts for a quick look after a silver run."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("current_price").isNull()).alias("null_price_count"),
        F.count_if(F.col("market_cap").isNull()).alias("null_mktcap_count"),
        F.count_if(F.col("coin_id").isNull()).alias("null_coinid_count"),
        F.count_if("is_bullish_24h").alias("bullish_coins"),
        F.avg(F.col("price_change_pct_24h")).alias("avg_24h_change_pct"),
        F.count("coin_id").alias("non_null_coins"),
    )


def _known(df: DataFrame, column: str) -> DataFrame:
    return distinct_rows(df.filter(F.col(column).isNotNull()), [column])


def dataset_summary(df: DataFrame) -> DataFrame:
    """One row describing the whole data set."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.avg(F.col("current_price")).alias("avg_price_usd"),
        F.sum(F.col("market_cap")).alias("total_market_cap"),
        F.sum(F.col("total_volume")).alias("total_volume_usd"),
        F.count_if("is_bullish_24h").alias("bullish_count"),
        F.count_if(~F.col("is_bullish_24h")).alias("bearish_count"),
        F.max("batch_ingested_at").alias("latest_ingestion"),
        F.min("batch_ingested_at").alias("earliest_ingestion"),
    ).withColumns({
        "unique_coins": _known(df, "coin_id").scalar(),
        "total_batches": _known(df, "ingestion_id").scalar(),
    })


def change_distribution(df: DataFrame, missing_as_lowest: bool = False) -> DataFrame:
    """Rows and mean change per bucket of the 24h change, ordered by label."""
    pct = F.col("price_change_pct_24h")
    return (
        df.groupBy(
            change_bucket(pct, missing_as_lowest).alias("price_bucket"),
            change_bucket_index(pct, missing_as_lowest).alias("bucket_index"),
        )
        .agg(F.count("*").alias("coin_count"), F.avg(pct).alias("avg_pct_change"))
        .orderBy("price_bucket")
    )


def silver_preview(df: DataFrame, n: int = 15) -> DataFrame:
    """The best-ranked rows of silver."""
    return df.select(
        "coin_id", "symbol", "name", "current_price", "market_cap", "total_volume",
        "price_change_pct_24h", "is_bullish_24h", "batch_ingested_at", "market_cap_rank",
    ).orderBy(
        F.col("market_cap_rank").asc_nulls_last(), F.col("batch_ingested_at").desc_nulls_last(), "coin_id",
    ).limit(n).drop("market_cap_rank")


def envelope_preview(envelopes: DataFrame, n: int = 5) -> DataFrame:
    return envelopes.select("ingestion_id", "ingested_at", "record_count").orderBy(
        F.col("ingested_at").desc_nulls_last(), "ingestion_id").limit(n)


def record_fields(records: DataFrame) -> DataFrame:
    """The main fields of raw records."""
    return records.select(
        F.col("coin.id").alias("coin_id"), "coin.name", "coin.current_price",
        "coin.market_cap", "coin.total_volume",
    )


def record_preview(records: DataFrame, n: int = 10) -> DataFrame:
    """A few raw records, in no particular order."""
    return record_fields(records).limit(n)
