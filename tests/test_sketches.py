from pyspark.sql import functions as F

from snapmart.operators import sketches
from snapmart.plans import reports
from snapmart.plans.gold import hours_of


def fact(spark, hours, entities):
    stamp = F.timestamp_seconds(F.lit(1_717_200_000) + F.col("id") % hours * 3600)
    return spark.range(hours * entities).select(
        (F.col("id") * 7919 % (entities * 3)).alias("coin_sk"), F.date_format(stamp, "yyyyMMddHH").cast("bigint").alias("date_sk"),
        F.to_date(stamp).alias("snapshot_date"), stamp.alias("batch_ingested_at"), F.lit(1.0).alias("market_cap"),
        F.lit(1.0).alias("total_volume"), F.lit(1.0).alias("price_change_pct_24h"), F.lit(True).alias("is_bullish_24h"))


def test_merged_sketches_estimate_any_range(spark, scratch):
    rows = fact(spark, 72, 3000).persist()
    sketches.store_sketches(sketches.hourly_sketches(rows), scratch)
    for since, until in ((None, None), ("2024-06-02", None), ("2024-06-01", "2024-06-03")):
        some = rows
        if since:
            some = some.filter(F.col("snapshot_date") >= since)
        if until:
            some = some.filter(F.col("snapshot_date") < until)
        got = sketches.distinct_entities(sketches.read_sketches(spark, scratch, since, until)).first()
        exact = some.select("coin_sk").distinct().count()
        assert got.rows == some.count() and abs(got.entities - exact) <= 4 * sketches.relative_error() * exact


def test_storing_again_replaces_only_its_days(spark, scratch):
    rows = fact(spark, 48, 50)
    sketches.store_sketches(sketches.hourly_sketches(rows), scratch)
    more = rows.filter("snapshot_date = '2024-06-02'").unionByName(
        rows.filter("snapshot_date = '2024-06-02'").withColumn("coin_sk", F.col("coin_sk") + 1_000_000))
    sketches.store_sketches(sketches.hourly_sketches(more), scratch)
    got = {str(r.snapshot_date): r.rows for r in sketches.distinct_entities(
        sketches.read_sketches(spark, scratch), "snapshot_date").collect()}
    one_day = rows.filter("snapshot_date = '2024-06-02'").count()
    assert got["2024-06-02"] == 2 * one_day and got["2024-06-01"] == rows.filter("snapshot_date = '2024-06-01'").count()
    plan = sketches.read_sketches(spark, scratch, "2024-06-02")._jdf.queryExecution().executedPlan().toString()
    assert "snapshot_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_bounds(spark):
    row = spark.range(1).select(
        sketches.within_bounds(F.lit(100_000), F.lit(101_000)).alias("near"),
        sketches.within_bounds(F.lit(100_000), F.lit(110_000)).alias("far")).first()
    assert row.near and not row.far


def test_trend_with_estimated_entities(spark):
    rows, as_of = fact(spark, 24, 2000), F.lit("2024-06-02").cast("timestamp")
    exact = {r.snapshot_hour: r.coins_tracked for r in reports.hourly_trend(rows, hours_of(rows), as_of).collect()}
    near = {r.snapshot_hour: r.coins_tracked
            for r in reports.hourly_trend(rows, hours_of(rows), as_of, distinct_error=0.01).collect()}
    assert exact.keys() == near.keys() and all(abs(near[h] - n) <= 0.05 * n for h, n in exact.items())
