"""The hourly market trend kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from snapmart.sources.triggers import read_triggers, write_trigger

# Totals of one hour; the mean follows from sum and count, so hours stay exact.
_STORED = T.StructType([
    T.StructField("snapshot_hour", T.TimestampType()), T.StructField("coins_tracked", T.LongType()),
    T.StructField("total_market_cap_usd", T.DoubleType()), T.StructField("total_volume_usd", T.DoubleType()),
    T.StructField("price_change_sum", T.DoubleType()), T.StructField("price_changes", T.LongType()),
    T.StructField("bullish_coins", T.LongType()), T.StructField("bearish_coins", T.LongType())])


def hourly_totals(rows: DataFrame, lateness: str) -> DataFrame:
    """Totals per hour of a stream of silver rows, which holds each snapshot once.

    The state of an hour is its totals and its set of entities. It is kept until the
    newest batch time less ``lateness`` has passed the hour; rows that come later still
    are dropped. Rows without a batch time belong to no hour.
    """
    dated = rows.filter(F.col("batch_ingested_at").isNotNull()).withWatermark("batch_ingested_at", lateness)
    change, bullish = F.col("price_change_pct_24h"), F.col("is_bullish_24h")
    return dated.groupBy(F.window("batch_ingested_at", "1 hour").alias("w")).agg(
        F.size(F.collect_set("coin_id")).cast("bigint").alias("coins_tracked"),
        F.sum("market_cap").alias("total_market_cap_usd"), F.sum("total_volume").alias("total_volume_usd"),
        F.sum(change).alias("price_change_sum"), F.count(change).alias("price_changes"),
        F.count_if(bullish).alias("bullish_coins"), F.count_if(~bullish).alias("bearish_coins"),
    ).select(F.col("w.start").alias("snapshot_hour"), *_STORED.fieldNames()[1:])


def start_hourly_trend(rows: DataFrame, path: str, checkpoint: str, lateness: str = "1 day",
                       **trigger) -> StreamingQuery:
    """Write the totals of every hour that a trigger has changed to the trigger's folder.

    Late rows correct their hour. A trigger that is run again replaces its folder.
    """
    writer = hourly_totals(rows, lateness).writeStream.outputMode("update").foreachBatch(
        lambda totals, number: write_trigger(totals, path, number))
    return writer.option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"processingTime": "1 minute"})).start()


def read_hourly_trend(spark: SparkSession, path: str) -> DataFrame:
    """The trend as it stands: of each hour the totals that were written last."""
    versions = read_triggers(spark, path, _STORED, "number")
    last = versions.groupBy("snapshot_hour").agg(
        F.max_by(F.struct(*_STORED.fieldNames()[1:]), "number").alias("last")).select("snapshot_hour", "last.*")
    return last.select(
        "snapshot_hour", "coins_tracked", "total_market_cap_usd", "total_volume_usd",
        (F.col("price_change_sum") / F.nullif("price_changes", F.lit(0))).alias("avg_price_change_pct"),
        "bullish_coins", "bearish_coins")


def compact_trend(spark: SparkSession, path: str, target: str) -> None:
    """Store the trend as it stands as one plain table."""
    read_hourly_trend(spark, path).write.mode("overwrite").parquet(target)
