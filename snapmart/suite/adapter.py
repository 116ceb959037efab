"""Test tables as market snapshots.

Each row of ``events`` is one raw record: the user is the entity, six hours make a
batch. A few values are malformed or missing on purpose, as a live source has them.
``lineitem`` is a second, larger subject: the part is the entity, the day the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapmart.functions import hour_key
from snapmart.plans.gold import hours_of, load_gold
from snapmart.plans.silver import to_silver
from snapmart.schemas import record_schema
from snapmart.session import scratch_path
from snapmart.sources.gold import GoldStore
from snapmart.sources.silver import read_silver, write_silver

LOADED_AT = "2024-03-01 00:00:00"

_ISO = r"yyyy-MM-dd\'T\'HH:mm:ss.SSSSSSXXX"

# Raw field -> expression over event_id, ts, user_id, event_type, value and k.
RECORD = {
    "id": "if(k = 98, null, cast(user_id as string))",
    "symbol": "if(k = 97, null, event_type)",
    "name": "concat('user-', user_id)",
    "image": "concat('img/', event_type)",
    "current_price": "if(event_type = 'error' and k < 50, 'n/a', cast(value as string))",
    "high_24h": "if(k = 10, null, value + k / 4.0D)",
    "low_24h": "value - k / 8.0D",
    "price_change_24h": "k - 50",
    "price_change_percentage_24h": "if(event_type = 'view' and k >= 90, null, (k - 50) / 4.0D)",
    "price_change_percentage_7d_in_currency": "(k - 30) / 8.0D",
    "market_cap": "if(k < 3, null, value * (1000 + k))",
    "market_cap_rank": "k + 1",
    "market_cap_change_24h": "value * (k - 50)",
    "market_cap_change_percentage_24h": "(k - 50) / 5.0D",
    "fully_diluted_valuation": "value * 2000",
    "total_volume": "value * k",
    "circulating_supply": "k * 100",
    "total_supply": "k * 110",
    "max_supply": "if(k < 50, null, k * 125)",
    "ath": "value + 100",
    "ath_change_percentage": "k / 2.0D - 100",
    "ath_date": f"if(k = 42, 'unknown', date_format(ts - interval 100 days, '{_ISO}'))",
    "atl": "value / 4",
    "atl_change_percentage": "k * 1.5D",
    "atl_date": f"date_format(ts - interval 900 days, '{_ISO}')",
    "last_updated": f"date_format(ts, '{_ISO}')",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "ts": F.col("ts").cast("timestamp"),
        "k": F.from_json("props", "k int").getField("k"),
    })


def events_to_records(events: DataFrame) -> DataFrame:
    """(ingestion_id, batch_ingested_at, coin) with text leaves, as bronze delivers them."""
    batch = F.expr("timestamp_seconds(unix_seconds(ts) div 21600 * 21600)")
    fields = [
        F.expr(RECORD[f.name]).cast("string").alias(f.name)
        for f in record_schema()
    ]
    return _events(events).withColumn("batch", batch).select(
        F.concat(F.lit("b"), F.date_format("batch", "yyyyMMddHH")).alias("ingestion_id"),
        F.date_format("batch", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("batch_ingested_at"),
        F.struct(*fields).alias("coin"),
    )


# Events that a task widens to records, which take some thirty times the bytes.
EVENTS_A_TASK = 200_000


def _spread(events: DataFrame) -> DataFrame:
    """The events in tasks of bounded size, however few row groups or splits their file has.

    The count comes from the file's footer.
    """
    tasks = -(-events.count() // EVENTS_A_TASK)
    # In order of time, so that a task has rows of few batches.
    return events.repartitionByRange(tasks, "ts", "event_id") if tasks > 1 else events


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_records(_spread(table(spark, sf_dir, "events")))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(records(spark, sf_dir))


def loaded_at():
    return F.lit(LOADED_AT).cast("timestamp")


_roots: dict[tuple[str, str], str] = {}
_built: set[str] = set()


def _root(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _roots:
        _roots[key] = scratch_path(spark, "mart")
    return _roots[key]


def silver_path(spark: SparkSession, sf_dir: str) -> str:
    """A silver table built from ``events``, once per application."""
    path = f"{_root(spark, sf_dir)}/silver"
    if path not in _built:
        write_silver(silver(spark, sf_dir), path)
        _built.add(path)
    return path


def stored(spark: SparkSession, sf_dir: str) -> str:
    """Root of the silver table and of gold tables built from it, once per application."""
    root = _root(spark, sf_dir)
    if root not in _built:
        load_gold(read_silver(spark, silver_path(spark, sf_dir)), f"{root}/gold", loaded_at())
        _built.add(root)
    return root


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, silver_path(spark, sf_dir))


def stored_gold(spark: SparkSession, sf_dir: str) -> GoldStore:
    return GoldStore(spark, f"{stored(spark, sf_dir)}/gold")


def line_items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact, entity dimension and date dimension out of ``lineitem`` and ``part``."""
    lines = table(spark, sf_dir, "lineitem").withColumn("shipped", F.col("l_shipdate").cast("timestamp"))
    parts = table(spark, sf_dir, "part")
    fact = lines.select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("snapshot_id"),
        F.col("l_partkey").alias("coin_sk"),
        hour_key(F.col("shipped")).alias("date_sk"),
        F.col("l_orderkey").cast("string").alias("ingestion_id"),
        F.col("l_extendedprice").alias("current_price"),
        F.col("l_quantity").alias("total_volume"),
        F.col("l_extendedprice").alias("market_cap"),
        ((F.lit(0.05) - F.col("l_discount")) * 100).alias("price_change_pct_24h"),
        (F.col("l_returnflag") == "A").alias("is_bullish_24h"),
        F.col("shipped").alias("batch_ingested_at"),
    )
    dim_coin = parts.select(
        F.col("p_partkey").alias("coin_sk"), F.col("p_partkey").cast("string").alias("coin_id"),
        F.col("p_name").alias("name"), F.col("p_brand").alias("symbol"))
    return fact, dim_coin, hours_of(fact)
