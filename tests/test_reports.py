import pytest
from pyspark.sql import functions as F

from snapmart.plans import reports

COINS = [(1, "aa", "Alpha", "a"), (2, "bb", "Beta", "b"), (3, "cc", "Gamma", "c")]


def dim_coin(spark, rows=COINS):
    return spark.createDataFrame(rows, "coin_sk bigint, coin_id string, name string, symbol string")


def fact(spark, rows):
    """(coin_sk, time, price, range, cap, volume, pct, bullish) rows."""
    schema = ("coin_sk bigint, at string, current_price double, price_range_24h double, market_cap double, "
              "total_volume double, price_change_pct_24h double, is_bullish_24h boolean")
    return spark.createDataFrame(rows, schema).select(
        "*", F.col("at").cast("timestamp").alias("batch_ingested_at"),
        F.concat_ws("_", "coin_sk", "at").alias("snapshot_id"), F.col("at").alias("ingestion_id"),
        F.date_format(F.col("at").cast("timestamp"), "yyyyMMddHH").cast("bigint").alias("date_sk"),
        (F.col("total_volume") / F.nullif(F.col("market_cap"), F.lit(0.0))).alias("volume_to_market_cap_ratio"))


OLD, NEW = "2024-06-14 10:00:00", "2024-06-15 10:00:00"
ROWS = [
    (1, OLD, 8.0, 1.0, 90.0, 5.0, 1.0, True), (1, NEW, 10.0, 2.0, 100.0, 5.0, 1.0, True),
    (2, NEW, 0.0, 1.0, 300.0, None, -1.0, False), (3, NEW, 5.0, None, 100.0, 9.0, None, None),
]


def names(df, column="name"):
    return [r[column] for r in df.collect()]


def test_top_volume_takes_the_newest_batch_and_ranks_missing_last(spark):
    got = reports.top_volume(fact(spark, ROWS), dim_coin(spark))
    assert names(got, "coin_name") == ["Gamma", "Alpha", "Beta"]
    assert got.filter("symbol = 'c'").first().volume_to_mcap_pct == 9.0
    assert names(reports.top_volume(fact(spark, ROWS), dim_coin(spark), 1), "coin_name") == ["Gamma"]


@pytest.mark.parametrize("n", [20, None])
def test_volatility_skips_zero_prices(spark, n):
    got = reports.volatility_rank(fact(spark, ROWS), dim_coin(spark), n).orderBy("volatility_rank").collect()
    assert [(r.name, r.volatility_pct, r.volatility_rank) for r in got] == [("Alpha", 20.0, 1), ("Gamma", None, 2)]


@pytest.mark.parametrize("n", [2, 15, None])
def test_market_cap_rank_leaves_gaps_after_ties(spark, n):
    got = reports.market_cap_rank(fact(spark, ROWS), dim_coin(spark), n)
    ranks = [(r.name, r["rank"]) for r in got.orderBy("rank", "name").collect()]
    assert ranks == [("Beta", 1), ("Alpha", 2), ("Gamma", 2)][:n]
    more = ROWS + [(4, NEW, 1.0, 1.0, 50.0, 1.0, 0.0, False)]
    coins = dim_coin(spark, COINS + [(4, "dd", "Delta", "d")])
    assert reports.market_cap_rank(fact(spark, more), coins, n and 15).filter("name = 'Delta'").first()["rank"] == 4


@pytest.mark.parametrize("n", [15, None])
def test_dominance(spark, n):
    got = reports.dominance(fact(spark, ROWS), dim_coin(spark), n).collect()
    assert [(r.name, r.dominance_pct, r.cumulative_dominance_pct) for r in got] == [
        ("Beta", 60.0, 60.0), ("Alpha", 20.0, 80.0), ("Gamma", 20.0, 100.0)]


def test_dominance_with_zero_or_negative_total(spark):
    zero = fact(spark, [(1, NEW, 1.0, 1.0, 0.0, 1.0, 1.0, True)])
    row = reports.dominance(zero, dim_coin(spark)).first()
    assert row.dominance_pct is None and row.cumulative_dominance_pct is None
    negative = fact(spark, [(1, NEW, 1.0, 1.0, -50.0, 1.0, 1.0, True), (2, NEW, 1.0, 1.0, 25.0, 1.0, 1.0, True)])
    for n in (15, None):
        rows = reports.dominance(negative, dim_coin(spark), n=n).collect()
        assert [(r.name, r.dominance_pct, r.cumulative_dominance_pct) for r in rows] == [
            ("Alpha", 200.0, 100.0), ("Beta", -100.0, -100.0)]



def test_change_of_the_first_snapshot(spark):
    rows = [(1, OLD, 8.0) + (None,) * 5, (1, NEW, 10.0) + (None,) * 5, (2, OLD, 0.0) + (None,) * 5,
            (2, NEW, 3.0) + (None,) * 5]
    got = reports.snapshot_change(fact(spark, rows), dim_coin(spark), None, include_next=True).collect()
    found = [(r.name, r.prev_price, r.next_price, r.price_delta, r.pct_change_from_prev_snapshot) for r in got]
    assert found == [
        ("Alpha", 8.0, None, 2.0, 25.0), ("Alpha", None, 10.0, 0.0, None),
        ("Beta", 0.0, None, 3.0, None), ("Beta", None, 3.0, 0.0, None)]


def test_symbol_filter(spark):
    got = reports.snapshot_change(fact(spark, ROWS), dim_coin(spark), ["a"])
    assert names(got) == ["Alpha", "Alpha"] and "next_price" not in got.columns
    assert reports.rolling_average(fact(spark, ROWS), dim_coin(spark)).count() == 0


def test_rolling_average_is_partial_at_the_start(spark):
    rows = [(1, f"2024-06-15 {h:02d}:00:00", float(h)) + (None,) * 5 for h in range(4)]
    got = reports.rolling_average(fact(spark, rows), dim_coin(spark), None, points=3).collect()
    assert [r.rolling_24h_avg_price for r in got] == [2.0, 1.0, 0.5, 0.0]
    assert [r.deviation_from_rolling_avg for r in got] == [1.0, 1.0, 0.5, 0.0]


def dim_date(spark, f):
    from snapmart.plans.gold import hours_of
    return hours_of(f)


def test_hourly_trend_counts_unknown_in_neither_direction(spark):
    f = fact(spark, ROWS)
    as_of = F.lit("2024-06-15 11:00:00").cast("timestamp")
    got = reports.hourly_trend(f, dim_date(spark, f), as_of).collect()
    assert [r.hour_of_day for r in got] == [10, 10] and got[0].day_of_month == 15
    assert (got[0].coins_tracked, got[0].bullish_coins, got[0].bearish_coins) == (3, 1, 1)
    assert (got[0].total_market_cap_usd, got[0].total_volume_usd, got[0].avg_price_change_pct) == (500.0, 14.0, 0.0)
    assert reports.hourly_trend(f, dim_date(spark, f), as_of, days=1).count() == 1
    edge = F.lit("2024-06-21 10:00:00").cast("timestamp")
    assert reports.hourly_trend(f, dim_date(spark, f), edge).count() == 2


def test_weekend_weekday(spark):
    days = [f"2024-06-{d:02d} 10:00:00" for d in range(3, 17)]
    rows = [(1, t, 1.0, 1.0, 1.0, 30.0 if t[8:10] in ("08", "09", "15", "16") else 20.0, 0.0, True) for t in days]
    rows += [(2, t, 1.0, 1.0, 1.0, 1.0, 0.0, True) for t in days[:9]]
    f = fact(spark, rows)
    got = reports.weekend_weekday(f, dim_coin(spark), dim_date(spark, f)).collect()
    assert [tuple(r) for r in got] == [("Alpha", "a", 30.0, 20.0, 50.0)]


def test_entities_of_one_name_are_added_up(spark):
    days = [f"2024-06-{d:02d} 10:00:00" for d in range(10, 16)]
    rows = [(c, t, 1.0, 1.0, 1.0, 10.0 * c, 0.0, True) for t in days for c in (1, 2)]
    f = fact(spark, rows)
    coins = dim_coin(spark, [(1, "aa", "Same", "s"), (2, "bb", "Same", "s")])
    row, = reports.weekend_weekday(f, coins, dim_date(spark, f)).collect()
    assert (row.avg_weekend_volume, row.avg_weekday_volume) == (15.0, 15.0)


def test_freshness_monitor(spark):
    f = fact(spark, ROWS)
    def at(text):
        return reports.freshness_monitor(f, F.lit(text).cast("timestamp")).first()
    row = at("2024-06-15 11:30:59")
    assert (row.lag_minutes, row.total_batches, row.total_records, row.distinct_coins) == (90, 2, 4, 3)
    assert row.pipeline_status.endswith("FRESH") and "STALE" in at("2024-06-15 11:31:00").pipeline_status
    empty = reports.freshness_monitor(f.limit(0), F.lit("2024-06-15").cast("timestamp")).first()
    assert empty.total_records == 0 and empty.last_ingestion_time is None and "STALE" in empty.pipeline_status


def test_row_without_entity_is_left_out(spark):
    got = reports.top_volume(fact(spark, ROWS), dim_coin(spark, COINS[:1]))
    assert names(got, "coin_name") == ["Alpha"]
