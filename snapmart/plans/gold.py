"""Silver to gold: staging, dimensions, fact."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from snapmart.functions import calendar_columns, greatest_or_zero, hour_key
from snapmart.operators.contracts import conform
from snapmart.operators.dedup import keep_latest
from snapmart.operators.keys import number_keys
from snapmart.operators.upsert import insert_if_absent, take_incoming, update_matched
from snapmart.schemas import (
    DIM_COIN_CONTRACT, DIM_DATE_CONTRACT, FACT_CONTRACT, FACT_MEASURES,
    STAGING_COLUMNS, STAGING_TIMESTAMPS, staging_schema,
)
from snapmart.session import materialised, require_utc
from snapmart.sources.files import remove
from snapmart.sources.gold import GoldStore, entity_buckets
from snapmart.sources.silver import read_silver
from snapmart.sources.tables import verify_counts

# Merge rules of the entity dimension; columns not named keep their stored value.
COIN_RULES = {
    "symbol": take_incoming,
    "name": take_incoming,
    "ath": greatest_or_zero,
    "circulating_supply": take_incoming,
    "last_updated_at": take_incoming,
}

_COIN_COLUMNS = (
    "coin_id", "symbol", "name", "ath", "atl", "ath_date", "atl_date",
    "circulating_supply", "total_supply", "max_supply",
)


def stage(silver: DataFrame, upper_case: bool = False) -> DataFrame:
    """The staging columns ``silver`` has, times as UTC timestamps (unreadable text NULL)."""
    kinds = dict(silver.dtypes)

    def column(name: str) -> Column:
        value = F.col(name)
        if name in STAGING_TIMESTAMPS:
            value = F.try_to_timestamp(value) if kinds[name] == "string" else value.cast("timestamp")
        return value.alias(name.upper() if upper_case else name)

    return silver.select(*[column(c) for c in STAGING_COLUMNS if c in kinds])


def load_staging(silver: DataFrame, path: str) -> dict[str, int]:
    """Replace the staging table; returns the rows written and how many cannot become facts."""
    counts = Observation("staging")
    stage(silver).observe(
        counts, F.count("*").alias("staged"), F.count_if(~_loadable()).alias("quarantined"),
    ).write.mode("overwrite").parquet(path)
    return dict(counts.get)


def hours_of(staging: DataFrame) -> DataFrame:
    """Date-dimension rows for every hour in staging."""
    hours = (
        staging.filter(F.col("batch_ingested_at").isNotNull())
        .select(F.date_trunc("hour", F.col("batch_ingested_at")).alias("hour")).distinct()
    )
    return conform(hours.select(*[
        c.alias(n) for n, c in calendar_columns(F.col("hour")).items()]), DIM_DATE_CONTRACT)


def latest_entities(staging: DataFrame, loaded_at: Column) -> DataFrame:
    """The newest staging row of every entity, stamped with the load time."""
    known = staging.filter(_loadable())
    narrow = known.select(*_COIN_COLUMNS, "batch_ingested_at", "last_updated", "ingestion_id")
    return (
        keep_latest(narrow, ["coin_id"], ["batch_ingested_at", "last_updated", "ingestion_id"])
        .select(*_COIN_COLUMNS, loaded_at.alias("last_updated_at"))
    )


def upsert_entities(dim: DataFrame, latest: DataFrame, loaded_at: Column, last_key: int | None = None) -> DataFrame:
    """The entity dimension after merging ``latest`` (one row per entity) into it.

    ``dim`` may be some buckets of the dimension, all that ``latest`` touches; the largest
    key of the whole is then ``last_key``.
    """
    last_key = F.coalesce(dim.agg(F.max("coin_sk")).scalar(), F.lit(0)) if last_key is None else F.lit(last_key)
    fresh = number_keys(insert_if_absent(dim, latest, ["coin_id"]), "coin_id", "coin_sk", last_key)
    fresh = conform(fresh, DIM_COIN_CONTRACT, loaded_at)
    return update_matched(dim, latest, "coin_id", COIN_RULES).unionByName(fresh)


def snapshot_id() -> Column:
    return F.concat("coin_id", F.lit("_"), "ingestion_id")


# Staging columns that the gold tables must have a value for, directly or in a key.
_NEEDED = ("coin_id", "ingestion_id", "batch_ingested_at", "symbol", "name", "current_price")


def _loadable() -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in _NEEDED])


def quarantined(staging: DataFrame) -> DataFrame:
    """Staging rows that would break a NOT NULL promise of the dimensions or the fact."""
    return staging.filter(~_loadable())


def quarantine_reasons(staging: DataFrame) -> DataFrame:
    """(missing_column, rows) over the quarantined rows; a row counts for each column it lacks."""
    counts = staging.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in _NEEDED])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("missing_column"), F.col(c).alias("rows")) for c in _NEEDED])))


def new_facts(staging: DataFrame, dim: DataFrame, stored: DataFrame, loaded_at: Column) -> DataFrame:
    """Fact rows for the snapshots in staging that ``stored`` (snapshot_id) does not hold.

    ``stored`` needs to have the stored ids among those of staging, on whatever day.
    """
    snapshots = keep_latest(
        staging.filter(_loadable()).select(
            snapshot_id().alias("snapshot_id"), "coin_id", "ingestion_id",
            *FACT_MEASURES, "batch_ingested_at", "last_updated"),
        ["snapshot_id"], ["last_updated", "batch_ingested_at"])
    absent = insert_if_absent(stored, snapshots, ["snapshot_id"])
    keyed = absent.join(dim.select("coin_id", "coin_sk"), "coin_id")
    return conform(
        keyed.withColumn("date_sk", hour_key(F.col("batch_ingested_at"))),
        FACT_CONTRACT, loaded_at)


def load_gold(silver: DataFrame, root: str, as_of: Column | None = None) -> dict[str, int]:
    """Load silver rows into the gold tables under ``root``.

    Every step can be repeated: dimensions are keyed, the fact only takes snapshots
    it lacks. A run that stops half-way is completed by running it again.
    """
    spark = silver.sparkSession
    store = GoldStore(spark, root)
    loaded_at = F.current_timestamp() if as_of is None else as_of
    require_utc(spark)
    # A folder of its own for each load, so loads do not read each other's rows.
    staging_path = f"{store.root}/staging/{uuid.uuid4().hex}"
    try:
        counts = load_staging(silver, staging_path)
        if counts["staged"] == 0:
            return counts
        staging = spark.read.schema(staging_schema()).parquet(staging_path)
        with materialised(latest_entities(staging, loaded_at), "entities") as latest:
            # Only the buckets with entities of this load are read and written again.
            buckets = entity_buckets(latest)
            if buckets:
                store.replace_dim_coin(upsert_entities(
                    store.dim_coin(buckets), latest, loaded_at, store.last_coin_sk()), whole=False)
        store.append_dim_date(insert_if_absent(store.dim_date(), hours_of(staging), ["date_sk"]))
        stored = store.fact_keys().of_buckets(staging.select(snapshot_id().alias("snapshot_id")))
        with materialised(new_facts(staging, store.dim_coin(buckets), stored, loaded_at), "facts") as facts:
            store.append_fact(facts)
        return counts
    finally:
        remove(spark, staging_path)


def run_silver_to_gold(spark: SparkSession, silver_path: str, root: str,
                       as_of: Column | None = None, since=None, until=None) -> DataFrame | None:
    """Load stored silver, optionally a time range of it; returns the row counts of gold.

    None means there was nothing to load.
    """
    outcome = load_gold(read_silver(spark, silver_path, since, until), root, as_of)
    return verify_counts(GoldStore(spark, root).tables()) if outcome["staged"] else None
