"""Named reports over the star schema.

``fact`` and the dimensions may be stored tables or any frames with their columns.
Reports on the newest batch should be given the newest day of a stored fact
(:meth:`GoldStore.newest_fact`); those on a time range use the day it is partitioned
by to read only the days they need. Ties are ordered by entity so that a report is the
same on every run; missing values rank last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.functions import (
    freshness_status, hour_key, minutes_between_boundaries, percent_of,
    round_half_away,
)
from snapmart.operators.latest import latest_batch
from snapmart.operators.ordered import over_history, over_time, rank_descending, running_total, top
from snapmart.operators.quality import distinct_rows
from snapmart.schemas import FACT_PARTITION

# --- Fixed values: default symbols of the per-entity reports ------------------
CHANGE_SYMBOLS = ("btc", "eth", "sol", "bnb", "xrp")
ROLLING_SYMBOLS = ("btc", "eth", "sol")
# --- End of fixed values ------------------------------------------------------


def _day(fact: DataFrame) -> str | None:
    return FACT_PARTITION if FACT_PARTITION in fact.columns else None


def _latest_with_names(fact: DataFrame, dim_coin: DataFrame) -> DataFrame:
    names = dim_coin.select("coin_sk", "coin_id", "name", "symbol")
    return latest_batch(fact).join(names, "coin_sk")


def top_volume(fact: DataFrame, dim_coin: DataFrame, n: int = 10) -> DataFrame:
    """Entities with the largest volume in the newest batch."""
    return _latest_with_names(fact, dim_coin).select(
        F.col("name").alias("coin_name"), "symbol", "current_price", "total_volume", "market_cap",
        round_half_away(F.col("volume_to_market_cap_ratio") * 100, 2).alias("volume_to_mcap_pct"),
        "price_change_pct_24h", "coin_id",
    ).transform(
        top, n, F.col("total_volume").desc_nulls_last(), F.col("coin_id"),
    ).drop("coin_id")


def _volatility(fact: DataFrame, dim_coin: DataFrame) -> DataFrame:
    ratio = F.try_divide(F.col("price_range_24h"), F.col("current_price"))
    return _latest_with_names(fact, dim_coin).filter("current_price > 0").select(
        "name", "symbol", "current_price", "price_range_24h",
        round_half_away(ratio * 100, 2).alias("volatility_pct"),
        ratio.alias("_ratio"), "coin_id",
    )


def volatility_rank(fact: DataFrame, dim_coin: DataFrame, n: int | None = 20) -> DataFrame:
    """Entities of the newest batch ranked by price range relative to price.

    ``n=None`` ranks the whole batch. With ``n`` only that many rows are ranked:
    every row that outranks one of them is among them.
    """
    rows = _volatility(fact, dim_coin)
    if n is None:
        return rank_descending(rows, "_ratio", "volatility_rank").drop("_ratio", "coin_id")
    best = rows.transform(top, n, F.col("_ratio").desc_nulls_last(), F.col("coin_id"))
    rank = F.rank().over(Window.orderBy(F.col("_ratio").desc_nulls_last()))
    return (
        best.withColumn("volatility_rank", rank.cast("bigint"))
        .orderBy("volatility_rank", "coin_id").drop("_ratio", "coin_id")
    )


def market_cap_rank(fact: DataFrame, dim_coin: DataFrame, n: int | None = 15) -> DataFrame:
    """Entities of the newest batch ranked by market cap; ``n=None`` ranks the whole batch."""
    rows = _latest_with_names(fact, dim_coin).select(
        "name", "symbol", "current_price", "market_cap", "total_volume", "price_change_pct_24h", "coin_id")
    if n is None:
        return rank_descending(rows, "market_cap", "rank").drop("coin_id")
    best = rows.transform(top, n, F.col("market_cap").desc_nulls_last(), F.col("coin_id"))
    rank = F.rank().over(Window.orderBy(F.col("market_cap").desc_nulls_last()))
    return best.withColumn("rank", rank.cast("bigint")).orderBy("rank", "coin_id").drop("coin_id")


def _distinct(column: str, error: float | None) -> Column:
    return F.count_distinct(column) if error is None else F.approx_count_distinct(column, error)


def hourly_trend(fact: DataFrame, dim_date: DataFrame, as_of: Column | None = None,
                 days: int = 7, distinct_error: float | None = None) -> DataFrame:
    """Totals per hour over the last ``days`` days before ``as_of``.

    Entities are counted exactly, or with ``distinct_error`` estimated within that
    relative standard deviation, which keeps a sketch per hour instead of all entities.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    start = as_of - F.make_dt_interval(F.lit(days))
    # Implied by the condition on the hour; these reach the scan of the fact.
    recent = fact.filter(F.col("date_sk") >= hour_key(start))
    if _day(fact):
        recent = recent.filter(F.col(FACT_PARTITION) >= F.to_date(start))
    per_hour = recent.groupBy("date_sk").agg(
        _distinct("coin_sk", distinct_error).alias("coins_tracked"),
        F.sum(F.col("market_cap")).alias("total_market_cap_usd"),
        F.sum(F.col("total_volume")).alias("total_volume_usd"),
        F.avg(F.col("price_change_pct_24h")).alias("avg_price_change_pct"),
        F.count_if("is_bullish_24h").alias("bullish_coins"),
        F.count_if(~F.col("is_bullish_24h")).alias("bearish_coins"),
    )
    hours = dim_date.filter(F.col("snapshot_hour") >= start).select(
        "date_sk", "snapshot_hour", "year", "month", "day_of_month", "hour_of_day")
    return hours.join(per_hour, "date_sk").drop("date_sk").orderBy(F.col("snapshot_hour").desc())


def _history(fact: DataFrame, dim_coin: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    named = dim_coin.select("coin_sk", "name", "symbol")
    if symbols is not None:
        named = named.filter(F.col("symbol").isin(*symbols))
    narrow = fact.select("coin_sk", "snapshot_id", "batch_ingested_at", "current_price")
    return narrow.join(named, "coin_sk")


def snapshot_change(fact: DataFrame, dim_coin: DataFrame, symbols: Sequence[str] | None = CHANGE_SYMBOLS,
                    include_next: bool = False, sliced: bool = True) -> DataFrame:
    """Price of every snapshot against the entity's previous one.

    ``symbols=None`` takes all entities; ``include_next`` adds the following price;
    ``sliced`` as in :func:`over_history`.
    """
    price = F.col("current_price")

    def neighbours(history):
        found = {"prev_price": F.lag(price).over(history)}
        if include_next:
            found["next_price"] = F.lead(price).over(history)
        return found

    rows = over_history(
        _history(fact, dim_coin, symbols), ["coin_sk"], ["batch_ingested_at", "snapshot_id"],
        neighbours, back=1, ahead=int(include_next), sliced=sliced)
    delta = price - F.coalesce("prev_price", price)
    following = ["next_price"] if include_next else []
    return rows.select(
        "name", "symbol", "batch_ingested_at", "current_price", "prev_price", *following,
        round_half_away(delta, 4).alias("price_delta"),
        round_half_away(percent_of(delta, F.col("prev_price")), 4).alias("pct_change_from_prev_snapshot"),
    ).orderBy("name", F.col("batch_ingested_at").desc())


def rolling_average(fact: DataFrame, dim_coin: DataFrame, symbols: Sequence[str] | None = ROLLING_SYMBOLS,
                    points: int = 24, sliced: bool = True) -> DataFrame:
    """Mean price over the last ``points`` snapshots of the entity, and the distance to it."""
    def frame(history):
        return {"_mean": F.avg("current_price").over(history.rowsBetween(1 - points, 0))}

    rows = over_history(
        _history(fact, dim_coin, symbols), ["coin_sk"], ["batch_ingested_at", "snapshot_id"],
        frame, back=points - 1, sliced=sliced)
    return rows.select(
        "name", "symbol", "batch_ingested_at", "current_price",
        round_half_away(F.col("_mean"), 6).alias("rolling_24h_avg_price"),
        round_half_away(F.col("current_price") - F.col("_mean"), 6).alias("deviation_from_rolling_avg"),
    ).orderBy("symbol", F.col("batch_ingested_at").desc())


def rolling_day_average(fact: DataFrame, dim_coin: DataFrame, symbols: Sequence[str] | None = ROLLING_SYMBOLS,
                        seconds: int = 86_400, sliced: bool = True) -> DataFrame:
    """Mean price over the last 24 hours of the entity, however many snapshots these hold,
    how many they are, and the distance to the mean."""
    rows = over_time(
        _history(fact, dim_coin, symbols), ["coin_sk"], "batch_ingested_at", seconds,
        lambda frame: {"_mean": F.avg("current_price").over(frame), "snapshots": F.count("*").over(frame)},
        sliced=sliced)
    return rows.select(
        "name", "symbol", "batch_ingested_at", "current_price", "snapshots",
        round_half_away(F.col("_mean"), 6).alias("day_avg_price"),
        round_half_away(F.col("current_price") - F.col("_mean"), 6).alias("deviation_from_day_avg"),
    ).orderBy("symbol", F.col("batch_ingested_at").desc())


_SHARE = "decimal(20,4)"


def dominance(fact: DataFrame, dim_coin: DataFrame, n: int | None = 15) -> DataFrame:
    """Share of the newest batch's market cap per entity, with its running sum.

    ``n=None`` lists the whole batch, else the first ``n`` rows by market cap with the
    running sum over them. A negative total gives negative shares; rows stay in order of
    market cap for the running sum.
    """
    newest = latest_batch(fact)
    total = newest.agg(F.sum(F.col("market_cap"))).scalar()
    share = round_half_away(percent_of(F.col("market_cap"), total), 4)
    rows = _latest_with_names(fact, dim_coin).select(
        "name", "symbol", "market_cap", share.alias("dominance_pct"),
        share.cast(_SHARE).alias("_share"), "coin_id")
    order = [F.col("market_cap").desc_nulls_last(), F.col("coin_id")]
    if n is None:
        rows = running_total(rows, "_share", order, "_upto")
    else:
        upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.transform(top, n, *order).withColumn("_upto", F.sum("_share").over(upto))
    return rows.select(
        "name", "symbol", "market_cap", "dominance_pct",
        F.col("_upto").cast("double").alias("cumulative_dominance_pct"), "coin_id",
    ).orderBy(F.col("dominance_pct").desc_nulls_last(), *order).drop("coin_id")


def weekend_weekday(fact: DataFrame, dim_coin: DataFrame, dim_date: DataFrame,
                    min_rows: int = 10, n: int = 20) -> DataFrame:
    """Mean volume on weekends against weekdays, largest difference first."""
    flagged = fact.select("coin_sk", "date_sk", "total_volume").join(
        dim_date.select("date_sk", "is_weekend"), "date_sk")
    weekend = F.when(F.col("is_weekend"), F.col("total_volume"))
    weekday = F.when(~F.col("is_weekend"), F.col("total_volume"))
    # One row per entity before names come in; entities of the same name are then added up.
    per_entity = flagged.groupBy("coin_sk").agg(
        F.count("*").alias("rows"),
        F.sum(weekend).alias("weekend"), F.count(weekend).alias("weekend_rows"),
        F.sum(weekday).alias("weekday"), F.count(weekday).alias("weekday_rows"),
    )

    def mean(kind: str) -> Column:
        return F.try_divide(F.sum(F.col(kind)), F.sum(f"{kind}_rows"))

    return (
        per_entity.join(dim_coin.select("coin_sk", "name", "symbol"), "coin_sk")
        .groupBy("name", "symbol")
        .agg(
            F.sum("rows").alias("_rows"),
            mean("weekend").alias("avg_weekend_volume"),
            mean("weekday").alias("avg_weekday_volume"),
        )
        .filter(F.col("_rows") >= min_rows).drop("_rows")
        .withColumn("weekend_vs_weekday_pct_diff", round_half_away(
            (F.try_divide(F.col("avg_weekend_volume"), F.col("avg_weekday_volume")) - 1) * 100, 2))
        .transform(top, n, F.abs("weekend_vs_weekday_pct_diff").desc_nulls_last(),
                   F.col("name"), F.col("symbol"))
    )


def freshness_monitor(fact: DataFrame, as_of: Column | None = None, max_lag_minutes: int = 90) -> DataFrame:
    """One row: newest and oldest batch, lag, totals and a status."""
    now = F.current_timestamp() if as_of is None else as_of
    per_entity = fact.groupBy("coin_sk").agg(
        F.count("*").alias("rows"),
        F.max("batch_ingested_at").alias("last"), F.min("batch_ingested_at").alias("first"))
    batches = distinct_rows(fact.filter("ingestion_id IS NOT NULL"), ["ingestion_id"])
    lag = minutes_between_boundaries(F.col("last_ingestion_time"), F.col("now"))
    return per_entity.agg(
        F.max("last").alias("last_ingestion_time"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_records"),
        F.count("coin_sk").alias("distinct_coins"),
        F.min("first").alias("earliest_record"),
    ).withColumn("now", now).withColumn("lag_minutes", lag).select(
        "last_ingestion_time", "now", "lag_minutes",
        batches.scalar().alias("total_batches"),
        "total_records", "distinct_coins", "earliest_record",
        freshness_status(F.col("lag_minutes"), max_lag_minutes).alias("pipeline_status"),
    )
