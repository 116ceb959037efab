"""Time reports over line items a third of which belong to one part.

``python hot_key.py [rows]`` on ``local[8]``; prints one line per report.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapmart.plans import reports
from snapmart.plans.gold import hours_of
from snapmart.functions import hour_key

PARTS = 20_000


def line_items(spark: SparkSession, rows: int) -> tuple[DataFrame, DataFrame]:
    """Fact and entity dimension; part 0 has a third of all rows."""
    n = F.col("id")
    stamp = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64(n), F.lit(86_400 * 365)))
    fact = spark.range(0, rows, 1, 64).select(
        n.cast("string").alias("snapshot_id"),
        F.when(n % 3 == 0, 0).otherwise(F.pmod(F.xxhash64(n, F.lit(1)), F.lit(PARTS))).cast("bigint").alias("coin_sk"),
        (n % 1000).cast("string").alias("ingestion_id"), stamp.alias("batch_ingested_at"),
        hour_key(stamp).alias("date_sk"), (n % 977 / 7).alias("current_price"),
        (n % 31).cast("double").alias("total_volume"), (n % 977 * 3.0).alias("market_cap"),
        (n % 21 - 10).cast("double").alias("price_change_pct_24h"), (n % 2 == 0).alias("is_bullish_24h"))
    parts = spark.range(PARTS).select(
        F.col("id").alias("coin_sk"), F.concat(F.lit("part-"), "id").alias("name"),
        (F.col("id") % 50).cast("string").alias("symbol"), F.col("id").cast("string").alias("coin_id"))
    return fact, parts


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 12_000_000
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    fact, parts = line_items(spark, rows)
    hours = hours_of(fact)
    as_of = F.lit("2024-11-15").cast("timestamp")
    for name, build in {
        "rolling average, plain window": lambda: reports.rolling_average(fact, parts, None, sliced=False),
        "rolling average, sliced history": lambda: reports.rolling_average(fact, parts, None),
        "weekend against weekday": lambda: reports.weekend_weekday(fact, parts, hours),
        "trend over all days": lambda: reports.hourly_trend(fact, hours, as_of, days=400),
        "freshness monitor": lambda: reports.freshness_monitor(fact, as_of),
    }.items():
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - start:.1f} s over {rows} rows")
    spark.stop()


if __name__ == "__main__":
    main()
