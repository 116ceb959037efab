"""Every registered query: a function of the session and the folder of test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapmart.functions import (
    calendar_columns, hour_key, minutes_between_boundaries, partition_parts, round_half_away,
)
from snapmart.operators import contracts, dedup, quality, sketches, summaries
from snapmart.operators.latest import newest_time
from snapmart.operators.ordered import over_history
from snapmart.operators.quality_state import QualityState
from snapmart.operators.records import (
    add_partition_columns, derive_measures, flatten_and_cast, flatten_records, keep_valid, rejected,
)
from snapmart.plans import gold, reports
from snapmart.plans.silver import (
    SNAPSHOT_KEY, deduplicate, run_bronze_to_silver, run_quality_on_silver,
)
from snapmart.schemas import CONTRACTS
from snapmart.session import scratch_path, scratch_scope
from snapmart.sources import bronze, bucketed
from snapmart.sources.gold import GoldStore
from snapmart.sources.silver import append_silver, read_silver, write_silver
from snapmart.sources.tables import verify_counts, write_table
from snapmart.streaming import ingest, trend
from snapmart.suite import adapter

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Column types that compare the same in every engine: no zones, one integer width."""
    width = {"timestamp": "timestamp_ntz", "int": "bigint", "smallint": "bigint"}
    return df.select(*[F.col(c).cast(width.get(kind, kind)).alias(c) for c, kind in df.dtypes])


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _flat(spark, sf_dir):
    return flatten_and_cast(adapter.records(spark, sf_dir))


# --- Bronze -------------------------------------------------------------------


def _bronze_folder(spark, sf_dir, layout):
    path = scratch_path(spark, "bronze")
    envelopes = bronze.build_envelopes(
        adapter.records(spark, sf_dir).withColumn(
            "batch_ingested_at", F.to_timestamp("batch_ingested_at")),
        "test_events", max_records=500)
    bronze.write_bronze(envelopes, path, layout, compression="gzip" if layout == "lines" else None)
    return path


@query
def bronze_explode_flatten(spark, sf_dir):
    """Envelopes written, read back, exploded and flattened."""
    path = _bronze_folder(spark, sf_dir, "lines")
    return flatten_records(bronze.read_bronze(spark, path, "lines"))


@query
def bronze_envelopes(spark, sf_dir):
    """Envelopes in one-document files, as previewed."""
    envelopes = bronze.read_envelopes(spark, _bronze_folder(spark, sf_dir, "documents"))
    return envelopes.groupBy("ingestion_id", "source", "ingested_at").agg(
        F.sum(F.col("record_count").cast("bigint")).alias("record_count"),
        F.sum(F.size("data")).alias("data_records"),
        F.count_if(F.col("_corrupt_record").isNotNull()).alias("corrupt_envelopes"))


@query
def bronze_to_silver(spark, sf_dir):
    """The whole first pipeline: bronze files to stored silver."""
    path = scratch_path(spark, "silver")
    run_bronze_to_silver(spark, _bronze_folder(spark, sf_dir, "lines"), path, "lines")
    return read_silver(spark, path)


@query
def bronze_since_until(spark, sf_dir):
    """Records of a range of hour folders."""
    path = _bronze_folder(spark, sf_dir, "lines")
    return flatten_records(bronze.read_bronze(
        spark, path, "lines", "2024-01-10", "2024-01-20 12:00:00")).select(
        *SNAPSHOT_KEY, "symbol", "current_price", "last_updated")


@query
def bronze_damaged(spark, sf_dir):
    """Counts of a run over envelopes of which those of two kinds of batch were cut short."""
    path, cut = _bronze_folder(spark, sf_dir, "lines"), scratch_path(spark, "cut")
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    batch = F.get_json_object("value", "$.ingestion_id")
    lines.select(
        F.when(batch.endswith("06"), F.expr("substring(value, 1, 60)")).otherwise(F.col("value"))
    ).write.text(cut)
    counts = run_bronze_to_silver(spark, cut, scratch_path(spark, "silver"), "lines")
    whole = lines.filter(batch.endswith("06")).count()
    return spark.createDataFrame(
        [(counts["seen"], counts["kept"], counts["damaged"] == whole)],
        "seen bigint, kept bigint, all_damage_counted boolean")


# --- Silver -------------------------------------------------------------------


@query
def record_fields(spark, sf_dir):
    """The fields of the record preview, for all raw records."""
    return summaries.record_fields(adapter.records(spark, sf_dir))


@query
def silver_derived(spark, sf_dir):
    """Derived measures and partition columns."""
    rows = flatten_records(adapter.records(spark, sf_dir))
    return rows.transform(derive_measures).transform(add_partition_columns).select(
        "ingestion_id", "coin_id", "last_updated", "price_range_24h",
        "volume_to_market_cap_ratio", "is_bullish_24h", "year", "month", "day", "hour")


@query
def silver_dedup(spark, sf_dir):
    """Latest record per snapshot."""
    return deduplicate(_flat(spark, sf_dir)).select(
        *SNAPSHOT_KEY, "symbol", "current_price", "total_volume", "last_updated")


@query
def silver_dedup_aggregate(spark, sf_dir):
    """Latest record per snapshot, by aggregation."""
    rows = dedup.keep_latest_by_aggregate(_flat(spark, sf_dir), SNAPSHOT_KEY, ["last_updated"])
    return rows.select(*SNAPSHOT_KEY, "symbol", "current_price", "total_volume", "last_updated")


@query
def event_dedup(spark, sf_dir):
    """Latest event per user, type and hour."""
    events = adapter.table(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", "ts"))
    return dedup.keep_latest(events, ["user_id", "event_type", "hour"], ["ts", "event_id"])


@query
def silver_filter_invalid(spark, sf_dir):
    """Rows that pass the sanity filter."""
    return keep_valid(_flat(spark, sf_dir)).select(
        *SNAPSHOT_KEY, "symbol", "current_price", "market_cap", "last_updated")


@query
def silver_rejected(spark, sf_dir):
    """Rows that fail the sanity filter."""
    return rejected(_flat(spark, sf_dir)).select(
        *SNAPSHOT_KEY, "symbol", "current_price", "market_cap", "last_updated")


@query
def silver_partitioned_roundtrip(spark, sf_dir):
    """Silver written by hour and read back in full."""
    path = scratch_path(spark, "silver")
    write_silver(adapter.silver(spark, sf_dir), path)
    return read_silver(spark, path)


@query
def silver_since_until(spark, sf_dir):
    """A time range of stored silver, read by partition."""
    return read_silver(
        spark, adapter.silver_path(spark, sf_dir), "2024-01-10", "2024-01-20 12:00:00",
    ).select(*SNAPSHOT_KEY, "batch_ingested_at", "current_price", "year", "month", "day", "hour")


@query
def silver_append_twice(spark, sf_dir):
    """Silver after the same rows were appended twice."""
    path, rows = scratch_path(spark, "silver"), adapter.silver(spark, sf_dir)
    append_silver(rows, path)
    append_silver(rows, path)
    return read_silver(spark, path).select(*SNAPSHOT_KEY, "current_price", "last_updated")


@query
def silver_preview(spark, sf_dir):
    """Best-ranked silver rows."""
    return summaries.silver_preview(adapter.stored_silver(spark, sf_dir))


# --- Data quality -------------------------------------------------------------


def _quality_as_of(rows):
    return newest_time(rows) + F.expr("interval 61 minutes 30 seconds")


@query
def dq_suite(spark, sf_dir):
    """All default checks on silver."""
    rows = adapter.stored_silver(spark, sf_dir)
    return quality.run_checks(rows, quality.default_rules(), _quality_as_of(rows))


@query
def dq_suite_from_states(spark, sf_dir):
    """The same verdicts merged from states per hour, which three refreshes have stored."""
    path = adapter.silver_path(spark, sf_dir)
    state = QualityState(spark, scratch_path(spark, "quality"), quality.default_rules())
    for since, until in ((None, "2024-01-11"), ("2024-01-10 12:00:00", "2024-01-21"), ("2024-01-21", None)):
        state.refresh(path, since, until)
    return state.verdicts(_quality_as_of(adapter.stored_silver(spark, sf_dir)))


@query
def dq_suite_raw(spark, sf_dir):
    """The checks with stricter limits on rows that were never cleaned."""
    rows = _flat(spark, sf_dir)
    late = newest_time(rows) + F.expr("interval 95 minutes")
    rules = quality.default_rules(max_null_pct=2.5, max_dup_pct=0.5, strict_volume=True)
    return quality.run_checks(rows, rules, late)


# --- Fixed values: the rules a configuration declares -------------------------
CONFIGURED_RULES = [
    {"column": "current_price", "check": "not_null"},
    {"column": "current_price", "check": "greater_than", "value": 0},
    {"column": "coin_id", "check": "not_null"},
    {"column": "market_cap", "check": "not_null"},
    {"column": "total_volume", "check": "greater_than", "value": 0},
]
# --- End of fixed values ------------------------------------------------------


@query
def dq_configured_rules(spark, sf_dir):
    """Checks declared as data."""
    rows = _flat(spark, sf_dir)
    return quality.run_checks(rows, quality.rules_from_config(CONFIGURED_RULES), _quality_as_of(rows))


@query
def dq_report(spark, sf_dir):
    """Totals of the stored report of a run on silver."""
    path = scratch_path(spark, "reports")
    as_of = _quality_as_of(adapter.stored_silver(spark, sf_dir))
    report = run_quality_on_silver(spark, adapter.silver_path(spark, sf_dir), path, as_of=as_of)
    return spark.read.schema(report.schema).json(path).select(
        "dataset", "total_checks", "passed", "failed", "overall_pass",
        F.size("results").alias("result_count"))


@query
def dq_summary_lines(spark, sf_dir):
    """The verdicts as lines of text."""
    return quality.summary_lines(dq_suite(spark, sf_dir))


@query
def dq_null_summary(spark, sf_dir):
    """Quick counts on rows that were never cleaned."""
    return significant(summaries.quality_summary(_flat(spark, sf_dir)), "avg_24h_change_pct")


@query
def small_amounts(spark, sf_dir):
    """Sums and means of very small amounts per kind of event."""
    events = adapter.table(spark, sf_dir, "events").withColumn("amount", F.col("value") * 1e-10)
    return significant(events.groupBy("event_type").agg(
        F.sum("amount").alias("total_amount"), F.avg("amount").alias("mean_amount")),
        "total_amount", "mean_amount")


@query
def null_counts(spark, sf_dir):
    """NULLs per column in one pass."""
    return summaries.null_counts(_flat(spark, sf_dir), [
        "coin_id", "symbol", "current_price", "high_24h", "market_cap", "max_supply", "ath_date",
        "price_change_pct_24h"])


@query
def dataset_summary(spark, sf_dir):
    """The summary dashboard."""
    return significant(
        summaries.dataset_summary(adapter.stored_silver(spark, sf_dir)),
        "avg_price_usd", "total_market_cap", "total_volume_usd")


@query
def change_distribution(spark, sf_dir):
    """Rows per bucket of price change."""
    return significant(
        summaries.change_distribution(adapter.stored_silver(spark, sf_dir)), "avg_pct_change")


@query
def change_distribution_missing_lowest(spark, sf_dir):
    """Rows per bucket, missing changes counted in the last one."""
    return significant(
        summaries.change_distribution(adapter.stored_silver(spark, sf_dir), missing_as_lowest=True),
        "avg_pct_change")


@query
def distinct_incl_null(spark, sf_dir):
    """Distinct values and duplicate rows, NULL being a value."""
    rows = _flat(spark, sf_dir)
    keys = ["coin_id", "batch_ingested_at"]
    return rows.agg(F.count("*").alias("total_rows")).select(
        "total_rows",
        quality.distinct_rows(rows, ["coin_id"]).scalar().alias("distinct_coins"),
        quality.distinct_rows(rows, ["symbol"]).scalar().alias("distinct_symbols"),
        (F.col("total_rows") - quality.distinct_rows(rows, keys).scalar()).alias("duplicate_rows"))


# --- Gold ---------------------------------------------------------------------


@query
def staging_projection(spark, sf_dir):
    """Staging columns with upper-case names."""
    return gold.stage(adapter.stored_silver(spark, sf_dir), upper_case=True)


@query
def table_sink(spark, sf_dir):
    """Staging through the generic table sink."""
    path = scratch_path(spark, "sink")
    rows = gold.stage(adapter.stored_silver(spark, sf_dir))
    write_table(rows, "parquet", "overwrite", path=path)
    return spark.read.schema(rows.schema).parquet(path).select(
        "coin_id", "ingestion_id", "market_cap", "ath_date", "is_bullish_24h")


@query
def dim_date_build(spark, sf_dir):
    """Hours of all batches with their calendar attributes."""
    return gold.hours_of(adapter.stored_silver(spark, sf_dir))


@query
def dim_date_of_orders(spark, sf_dir):
    """Calendar attributes of every order date."""
    orders = adapter.table(spark, sf_dir, "orders")
    return gold.hours_of(orders.select(F.col("o_orderdate").cast("timestamp").alias("batch_ingested_at")))


SECOND_LOAD_FROM = "2024-01-16"


def _two_loads(spark, sf_dir):
    """Gold after loading the first half of the month, then the whole of silver."""
    root, rows = scratch_path(spark, "gold"), adapter.stored_silver(spark, sf_dir)
    early = rows.filter(F.col("batch_ingested_at") < F.lit(SECOND_LOAD_FROM).cast("timestamp"))
    gold.load_gold(early, root, F.lit("2024-02-01").cast("timestamp"))
    gold.load_gold(rows, root, F.lit("2024-02-02").cast("timestamp"))
    return GoldStore(spark, root)


@query
def dim_entity_upsert(spark, sf_dir):
    """Entity dimension after two loads: kept, updated and new entities."""
    return _two_loads(spark, sf_dir).dim_coin()


@query
def fact_load_incremental(spark, sf_dir):
    """Fact after two overlapping loads."""
    return _two_loads(spark, sf_dir).fact()


@query
def fact_load_duplicates(spark, sf_dir):
    """Fact from rows that repeat snapshots, loaded twice."""
    root = scratch_path(spark, "gold")
    rows = keep_valid(_flat(spark, sf_dir))
    gold.load_gold(rows, root, adapter.loaded_at())
    gold.load_gold(rows, root, adapter.loaded_at())
    return GoldStore(spark, root).fact().select(
        "snapshot_id", "date_sk", "current_price", "total_volume", "last_updated")


@query
def quarantined_rows(spark, sf_dir):
    """Staging rows that cannot become facts."""
    return gold.quarantined(gold.stage(_flat(spark, sf_dir))).select(
        "coin_id", "ingestion_id", "symbol", "current_price", "last_updated")


@query
def quarantine_reasons(spark, sf_dir):
    """How many staged rows lack each value that gold needs."""
    return gold.quarantine_reasons(gold.stage(_flat(spark, sf_dir)))


@query
def fact_redelivered(spark, sf_dir):
    """Fact after all snapshots came again with a batch time a day later: as after the first load."""
    root, rows = scratch_path(spark, "gold"), adapter.stored_silver(spark, sf_dir)
    later = F.col("batch_ingested_at") + F.expr("interval 1 day")
    gold.load_gold(rows, root, adapter.loaded_at())
    gold.load_gold(rows.withColumn("batch_ingested_at", later), root, adapter.loaded_at())
    return GoldStore(spark, root).fact().select(
        "snapshot_id", "date_sk", "batch_ingested_at", "current_price", "snapshot_date")


@query
def silver_to_gold(spark, sf_dir):
    """The whole second pipeline: row counts after loading stored silver."""
    return gold.run_silver_to_gold(
        spark, adapter.silver_path(spark, sf_dir), scratch_path(spark, "gold"), adapter.loaded_at())


@query
def table_counts(spark, sf_dir):
    """Row counts of the stored gold tables."""
    return verify_counts(adapter.stored_gold(spark, sf_dir).tables())


@query
def contract_violations(spark, sf_dir):
    """Every promise of the three gold tables, checked."""
    tables = adapter.stored_gold(spark, sf_dir).tables()
    found = None
    for name, contract in CONTRACTS.items():
        rows = contracts.contract_violations(tables[name], contract, tables)
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def contract_violations_broken(spark, sf_dir):
    """The same checks on gold tables with rows that break every kind of promise."""
    tables = adapter.stored_gold(spark, sf_dir).tables()
    fact, coins, hours = (tables[n] for n in ("fact_market_snapshot", "dim_coin", "dim_date"))
    bullish = fact.filter("is_bullish_24h")
    broken = {
        # Copies without a price, of an entity and an hour that do not exist.
        "fact_market_snapshot": fact.unionByName(bullish.withColumns({
            "current_price": F.lit(None).cast("double"), "coin_sk": F.lit(-1).cast("bigint"),
            "date_sk": F.lit(-1).cast("bigint")})),
        "dim_coin": coins.unionByName(coins.filter("symbol = 'click'").withColumn(
            "name", F.lit(None).cast("string"))),
        "dim_date": hours.unionByName(hours.filter("is_weekend").withColumn(
            "day_name", F.lit(None).cast("string"))),
    }
    found = None
    for name, contract in CONTRACTS.items():
        rows = contracts.contract_violations(broken[name], contract, broken)
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def fact_orphans(spark, sf_dir):
    """Violations in a fact made of line items checked against a part of its dimensions."""
    fact, dim_coin, dim_date = adapter.line_items(spark, sf_dir)
    tables = {"dim_coin": dim_coin.filter("symbol <> 'Brand#1'"), "dim_date": dim_date}
    return contracts.contract_violations(fact, CONTRACTS["fact_market_snapshot"], tables)


# --- Reports ------------------------------------------------------------------


def _star(spark, sf_dir):
    store = adapter.stored_gold(spark, sf_dir)
    return store.fact(), store.dim_coin(), store.dim_date()


def _newest(spark, sf_dir):
    store = adapter.stored_gold(spark, sf_dir)
    return store.newest_fact(), store.dim_coin()


def _after_last(fact, interval):
    return newest_time(fact) + F.expr(f"interval {interval}")


def significant(df: DataFrame, *columns: str, digits: int = 10) -> DataFrame:
    """Sums and means to so many digits: the last ones depend on the order of adding up.

    The factor moves amounts off the middle between two roundings, where they often lie.
    """
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.format_string(
            f"%.{digits - 1}e", F.col(c) * 1.000000000003).try_cast("double")) for c in columns})


def _stored(spark, build):
    """The rows of a report in a table of their own; what it needed on the way is removed."""
    path = scratch_path(spark, "report")
    with scratch_scope(spark):
        rows = build()
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


SYMBOLS = ("click", "view", "purchase")


@query
def top_volume(spark, sf_dir):
    fact, coins = _newest(spark, sf_dir)
    return reports.top_volume(fact, coins)


@query
def volatility_rank(spark, sf_dir):
    fact, coins = _newest(spark, sf_dir)
    return reports.volatility_rank(fact, coins)


@query
def volatility_rank_all(spark, sf_dir):
    """The ranking over the whole newest batch."""
    fact, coins = _newest(spark, sf_dir)
    return reports.volatility_rank(fact, coins, n=None)


@query
def hourly_trend(spark, sf_dir):
    fact, _, hours = _star(spark, sf_dir)
    newest, _ = _newest(spark, sf_dir)
    return significant(
        reports.hourly_trend(fact, hours, _after_last(newest, "1 hour")),
        "total_market_cap_usd", "total_volume_usd", "avg_price_change_pct")


@query
def snapshot_change(spark, sf_dir):
    fact, coins, _ = _star(spark, sf_dir)
    return reports.snapshot_change(fact, coins, SYMBOLS)


@query
def snapshot_change_all(spark, sf_dir):
    """Previous and next price of every snapshot of every entity."""
    fact, coins, _ = _star(spark, sf_dir)
    return _stored(spark, lambda: reports.snapshot_change(fact, coins, None, include_next=True))


@query
def snapshot_change_sliced(spark, sf_dir):
    """The same, on the path for entities too large for one task."""
    fact, coins, _ = _star(spark, sf_dir)
    return _stored(spark, lambda: reports.snapshot_change(fact, coins, None, include_next=True))


@query
def snapshot_change_bucketed(spark, sf_dir):
    """The same from tables laid out by entity: neither join nor window shuffles the fact."""
    fact, coins, _ = _star(spark, sf_dir)
    prefix = f"by_entity_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "report")
    bucketed.store_by_entity(fact, coins, prefix)
    try:
        rows = reports.snapshot_change(
            *bucketed.read_by_entity(spark, prefix), None, include_next=True, sliced=False)
        rows.write.parquet(path)
    finally:
        bucketed.drop_by_entity(spark, prefix)
    return spark.read.parquet(path)


@query
def dominance(spark, sf_dir):
    fact, coins = _newest(spark, sf_dir)
    return reports.dominance(fact, coins)


@query
def dominance_all(spark, sf_dir):
    """Shares and running sum over the whole newest batch."""
    fact, coins = _newest(spark, sf_dir)
    return _stored(spark, lambda: reports.dominance(fact, coins, n=None))


@query
def weekend_weekday(spark, sf_dir):
    return significant(
        reports.weekend_weekday(*_star(spark, sf_dir)), "avg_weekend_volume", "avg_weekday_volume")


@query
def rolling_average(spark, sf_dir):
    fact, coins, _ = _star(spark, sf_dir)
    return reports.rolling_average(fact, coins, SYMBOLS)


@query
def rolling_average_sliced(spark, sf_dir):
    """The same over all entities, on the path for entities too large for one task."""
    fact, coins, _ = _star(spark, sf_dir)
    return _stored(spark, lambda: reports.rolling_average(fact, coins, None))


@query
def rolling_day_average(spark, sf_dir):
    """Mean price over the last 24 hours, by time, of every snapshot of every entity."""
    fact, coins, _ = _star(spark, sf_dir)
    return _stored(spark, lambda: reports.rolling_day_average(fact, coins, None))


@query
def line_rolling_week_average(spark, sf_dir):
    """Mean price of a part over the last seven days, by time."""
    fact, parts, _ = adapter.line_items(spark, sf_dir)
    return _stored(spark, lambda: reports.rolling_day_average(fact, parts, None, seconds=7 * 86_400))


@query
def distinct_entities_by_day(spark, sf_dir):
    """Distinct entities per day, exact, and whether hourly sketches merged per day agree."""
    fact, _, _ = _star(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    sketches.store_sketches(sketches.hourly_sketches(fact), path)
    merged = sketches.distinct_entities(sketches.read_sketches(spark, path), "snapshot_date")
    exact = fact.groupBy("snapshot_date").agg(F.count_distinct("coin_sk").alias("exact_entities"))
    return exact.join(merged, "snapshot_date").select(
        "snapshot_date", "rows", "exact_entities",
        sketches.within_bounds(F.col("exact_entities"), F.col("entities")).alias("estimate_within_bounds"))


@query
def distinct_parts_by_month(spark, sf_dir):
    """The same over line items, merged per month of shipping."""
    fact, _, _ = adapter.line_items(spark, sf_dir)
    dated = fact.withColumn("snapshot_date", F.to_date("batch_ingested_at"))
    path = scratch_path(spark, "sketches")
    sketches.store_sketches(sketches.hourly_sketches(dated).withColumn(
        "snapshot_date", F.trunc("snapshot_date", "month")), path)
    merged = sketches.distinct_entities(sketches.read_sketches(spark, path), "snapshot_date")
    exact = dated.groupBy(F.trunc("snapshot_date", "month").alias("snapshot_date")).agg(
        F.count_distinct("coin_sk").alias("exact_parts"))
    return exact.join(merged, "snapshot_date").select(
        F.col("snapshot_date").alias("month"), "rows", "exact_parts",
        sketches.within_bounds(F.col("exact_parts"), F.col("entities")).alias("estimate_within_bounds"))


@query
def freshness_monitor(spark, sf_dir):
    fact, _, _ = _star(spark, sf_dir)
    return reports.freshness_monitor(fact, _after_last(fact, "89 minutes 59 seconds"))


@query
def freshness_monitor_stale(spark, sf_dir):
    fact, _, _ = _star(spark, sf_dir)
    return reports.freshness_monitor(fact, _after_last(fact, "91 minutes"))


@query
def marketcap_rank(spark, sf_dir):
    fact, coins = _newest(spark, sf_dir)
    return reports.market_cap_rank(fact, coins)


@query
def marketcap_rank_all(spark, sf_dir):
    """The ranking over the whole newest batch."""
    fact, coins = _newest(spark, sf_dir)
    return reports.market_cap_rank(fact, coins, n=None)


# --- Reports on line items ----------------------------------------------------


@query
def line_hourly_trend(spark, sf_dir):
    """Totals per shipping day over the last year."""
    fact, _, days = adapter.line_items(spark, sf_dir)
    trend = reports.hourly_trend(fact, days, _after_last(fact, "1 hour"), days=365)
    rounded = trend.withColumn("avg_price_change_pct", round_half_away(F.col("avg_price_change_pct"), 6))
    return significant(rounded, "total_market_cap_usd", "total_volume_usd")


@query
def line_weekend_weekday(spark, sf_dir):
    """Mean quantity on weekends against weekdays per part name and brand."""
    return significant(
        reports.weekend_weekday(*adapter.line_items(spark, sf_dir)), "avg_weekend_volume", "avg_weekday_volume")


@query
def line_rolling_average(spark, sf_dir):
    """Rolling price per part over all line items."""
    fact, parts, _ = adapter.line_items(spark, sf_dir)
    return reports.rolling_average(fact, parts, None)


@query
def line_snapshot_change(spark, sf_dir):
    """Price change per part for a few brands."""
    fact, parts, _ = adapter.line_items(spark, sf_dir)
    return reports.snapshot_change(fact, parts, ["Brand#1", "Brand#2", "Brand#3"])


@query
def line_top_volume(spark, sf_dir):
    """Largest quantities on the last shipping day."""
    fact, parts, _ = adapter.line_items(spark, sf_dir)
    fact = fact.withColumn("volume_to_market_cap_ratio", F.col("total_volume") / F.col("market_cap"))
    return reports.top_volume(fact, parts)


@query
def line_freshness(spark, sf_dir):
    """Totals and age of the line items."""
    fact, _, _ = adapter.line_items(spark, sf_dir)
    return reports.freshness_monitor(fact, _after_last(fact, "2 hours"))


# --- Streams ------------------------------------------------------------------


def _drain(stream):
    stream.awaitTermination()


@query
def stream_first_seen(spark, sf_dir):
    """Bronze folder streamed to silver in several batches, repeats dropped."""
    source, target = _bronze_folder(spark, sf_dir, "lines"), scratch_path(spark, "stream")
    rows = ingest.stream_rows(spark, source, "lines", max_files_per_trigger=60)
    _drain(ingest.start_first_seen(rows, target, scratch_path(spark, "progress"), availableNow=True))
    return read_silver(spark, target).select(*SNAPSHOT_KEY)


LATENESS = "3 days"


def _waves(records):
    """Records in the order they arrive: the month in thirds, some a wave late, some again."""
    ts = F.to_timestamp("coin.last_updated")
    wave = F.when(ts < "2024-01-11", 1).when(ts < "2024-01-21", 2).otherwise(3)
    late, again = F.second(ts) % 7 == 0, F.second(ts) % 5 == 0
    waves = F.when(late, F.array(wave + 1)).when(again, F.array(wave, wave + 1)).otherwise(F.array(wave))
    return records.withColumn("wave", F.explode(waves))


@query
def stream_first_seen_within(spark, sf_dir):
    """Snapshots that arrive in four waves, with repeats, late and too late ones, between
    which the stream is stopped and started again."""
    source, target, progress, held = [scratch_path(spark, x) for x in ("bronze", "stream", "progress", "waves")]
    records = _waves(adapter.records(spark, sf_dir)).withColumn(
        "batch_ingested_at", F.to_timestamp("batch_ingested_at"))
    # Events are widened to records once, not for every wave anew.
    records.write.partitionBy("wave").parquet(held)
    held_records = spark.read.schema(records.schema).parquet(held)
    for wave in range(1, 5):
        arriving = held_records.filter(F.col("wave") == wave).drop("wave")
        bronze.write_bronze(bronze.build_envelopes(arriving, "test_events", max_records=500), source, "lines")
        rows = ingest.stream_rows(spark, source, "lines")
        _drain(ingest.start_first_seen_within(rows, target, progress, LATENESS, availableNow=True))
    return read_silver(spark, target).select(*SNAPSHOT_KEY, "batch_ingested_at")


@query
def stream_landing(spark, sf_dir):
    """Rows of a stream some of whose envelopes end after their head, and how many did."""
    path, cut = _bronze_folder(spark, sf_dir, "lines"), scratch_path(spark, "cut")
    rows, damaged, progress = [scratch_path(spark, x) for x in ("landed", "damaged", "progress")]
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    batch = F.get_json_object("value", "$.ingestion_id")
    lines.select(F.when(batch.endswith("06"), F.expr("substring(value, 1, 60)")).otherwise(F.col("value"))).write.text(cut)
    _drain(ingest.start_landing(
        spark, cut, rows, damaged, progress, "lines", max_files_per_trigger=3, availableNow=True))
    found = ingest.read_damaged(spark, damaged).agg(F.count("*").alias("damaged")).crossJoin(
        lines.agg(F.count_if(batch.endswith("06")).alias("shortened")))
    return ingest.read_landed(spark, rows).crossJoin(F.broadcast(found)).select(
        *SNAPSHOT_KEY, "current_price", "last_updated",
        (F.col("damaged") == F.col("shortened")).alias("all_damage_kept"))


@query
def stream_hourly_trend(spark, sf_dir):
    """Totals per hour of silver that arrives in four waves, of which some rows are a wave late."""
    source, target, progress = [scratch_path(spark, x) for x in ("arriving", "trend", "progress")]
    stamp = F.col("batch_ingested_at")
    wave = F.when(stamp < "2024-01-11", 1).when(stamp < "2024-01-21", 2).otherwise(3)
    late = F.pmod(F.xxhash64(*SNAPSHOT_KEY), F.lit(7)) == 0
    rows = adapter.stored_silver(spark, sf_dir).withColumn("wave", wave + F.when(late, 1).otherwise(0))
    for number in range(1, 5):
        write_silver(rows.filter(F.col("wave") == number).drop("wave"), source, mode="append")
        _drain(trend.start_hourly_trend(
            ingest.stream_silver(spark, source), target, progress, "40 days", availableNow=True))
    return significant(
        trend.read_hourly_trend(spark, target),
        "total_market_cap_usd", "total_volume_usd", "avg_price_change_pct")


@query
def stream_keep_latest(spark, sf_dir):
    """Bronze folder streamed to silver in several batches, latest row kept."""
    source, target = _bronze_folder(spark, sf_dir, "lines"), scratch_path(spark, "stream")
    _drain(ingest.start_keep_latest(
        ingest.stream_rows(spark, source, "lines", max_files_per_trigger=60), target,
        scratch_path(spark, "progress"), availableNow=True))
    return ingest.read_latest(spark, target).select(
        *SNAPSHOT_KEY, "symbol", "current_price", "total_volume", "last_updated")


@query
def stream_gold(spark, sf_dir):
    """Stored silver streamed into gold: the resulting fact."""
    silver_path, root = adapter.silver_path(spark, sf_dir), scratch_path(spark, "gold")
    _drain(ingest.start_gold_refresh(
        ingest.stream_silver(spark, silver_path), root, scratch_path(spark, "progress"),
        adapter.loaded_at(), availableNow=True))
    store = GoldStore(spark, root)
    return store.fact().join(store.dim_coin().select("coin_sk", "coin_id"), "coin_sk").select(
        "snapshot_id", "coin_id", "date_sk", "current_price", "market_cap", "last_updated")


# --- Column functions ---------------------------------------------------------


@query
def time_functions(spark, sf_dir):
    """Hour key, partition parts, calendar and minute arithmetic on every event."""
    events = adapter.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"))
    ts = F.col("ts")
    calendar = calendar_columns(F.date_trunc("hour", ts))
    return events.select(
        "event_id", hour_key(ts).alias("date_sk"),
        *[c.alias(n) for n, c in partition_parts(ts).items()],
        calendar["quarter"].alias("quarter"), calendar["day_name"].alias("day_name"),
        calendar["month_name"].alias("month_name"), calendar["is_weekend"].alias("is_weekend"),
        minutes_between_boundaries(ts, F.lit("2024-02-01 00:00:30").cast("timestamp")).alias("minutes"))


@query
def neighbours_of_orders(spark, sf_dir):
    """Previous and next order value per customer."""
    orders = adapter.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return over_history(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"],
        lambda w: {"prev_total": F.lag("o_totalprice").over(w), "next_total": F.lead("o_totalprice").over(w)},
        back=1, ahead=1)
