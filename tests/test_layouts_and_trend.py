import re

from pyspark.sql import functions as F

from samples import record, silver_of
from snapmart.plans import reports
from snapmart.sources.bucketed import drop_by_entity, read_by_entity, store_by_entity
from snapmart.sources.silver import write_silver
from snapmart.sources.triggers import finished_triggers
from snapmart.streaming import ingest, trend


def star(spark):
    fact = spark.range(4000).select(
        (F.col("id") % 37).alias("coin_sk"), F.col("id").cast("string").alias("snapshot_id"),
        F.timestamp_seconds(F.col("id") * 61).alias("batch_ingested_at"), (F.col("id") % 101 + 1.0).alias("current_price"))
    coins = spark.range(37).select(F.col("id").alias("coin_sk"), F.concat(F.lit("n"), "id").alias("name"), F.lit("s").alias("symbol"))
    return fact, coins


def test_no_shuffle_between_bucketed_tables(spark):
    fact, coins = star(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store_by_entity(fact, coins, "by_entity_test", buckets=4)
        rows = reports.snapshot_change(*read_by_entity(spark, "by_entity_test"), None, include_next=True, sliced=False)
        got = sorted(map(str, rows.collect()))
        plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # The one exchange sorts the result.
        assert re.findall(r"Exchange (\w+)", plan) == ["rangepartitioning"]
        assert got == sorted(map(str, reports.snapshot_change(fact, coins, None, include_next=True, sliced=False).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        drop_by_entity(spark, "by_entity_test")


def at(day, hour, minute=0):
    return f"2024-06-{day:02d}T{hour:02d}:{minute:02d}:00Z"


def test_hourly_trend_is_corrected_by_late_rows(spark, scratch):
    silver, path = f"{scratch}/silver", f"{scratch}/trend"

    def arrive(*rows):
        write_silver(silver_of(spark, list(rows)), silver, mode="append")
        trend.start_hourly_trend(
            ingest.stream_silver(spark, silver), path, f"{scratch}/progress", "2 days", availableNow=True).awaitTermination()
        return {str(r.snapshot_hour): (r.coins_tracked, r.total_volume_usd, r.avg_price_change_pct, r.bullish_coins)
                for r in trend.read_hourly_trend(spark, path).collect()}

    first = arrive(("b1", at(1, 10, 6), record()), ("b1", at(1, 10, 6), record(id="bb")), ("b0", None, record()))
    assert len(first) == 1 and first["2024-06-01 10:00:00"][:3] == (2, 100.5, 5.0)
    # The next hour, and a late row of the first; the entity counts once in an hour.
    second = arrive(("b2", at(1, 11, 6), record()), ("b1b", at(1, 10, 36), record()),
                    ("b1b", at(1, 10, 36), record(id="cc", price_change_percentage_24h=None)))
    assert second["2024-06-01 10:00:00"][:3] == (3, 201.0, 5.0) and second["2024-06-01 11:00:00"][:2] == (1, 50.25)
    # Far ahead: the first day is closed, what comes for it then is dropped.
    arrive(("b9", at(9, 1), record()))
    last = arrive(("b3", at(1, 10, 50), record(id="zz")), ("b8", at(8, 1), record()))
    assert last["2024-06-01 10:00:00"] == second["2024-06-01 10:00:00"] and len(last) == 4
    trend.compact_trend(spark, path, f"{scratch}/plain")
    assert spark.read.parquet(f"{scratch}/plain").count() == 4
    assert len(finished_triggers(spark, path)) >= 4


def test_no_trend_yet(spark, scratch):
    assert trend.read_hourly_trend(spark, f"{scratch}/none").count() == 0
