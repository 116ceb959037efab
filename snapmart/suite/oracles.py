"""SQL over the test tables that each registered query must agree with."""

from __future__ import annotations

# Every event as a typed raw record.
FLAT = """
events_k AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS batch
  FROM events),
flat AS (
  SELECT 'b' || strftime(batch, '%Y%m%d%H') AS ingestion_id,
    batch AS batch_ingested_at,
    CASE WHEN k <> 98 THEN CAST(user_id AS VARCHAR) END AS coin_id,
    CASE WHEN k <> 97 THEN event_type END AS symbol,
    'user-' || user_id AS name,
    CASE WHEN NOT (event_type = 'error' AND k < 50) THEN value END AS current_price,
    CASE WHEN k <> 10 THEN value + k / 4.0::DOUBLE END AS high_24h,
    value - k / 8.0::DOUBLE AS low_24h,
    CAST(k - 50 AS DOUBLE) AS price_change_24h,
    CASE WHEN NOT (event_type = 'view' AND k >= 90) THEN (k - 50) / 4.0::DOUBLE END AS price_change_pct_24h,
    (k - 30) / 8.0::DOUBLE AS price_change_pct_7d,
    CASE WHEN k >= 3 THEN value * (1000 + k)::DOUBLE END AS market_cap,
    CAST(k + 1 AS BIGINT) AS market_cap_rank,
    value * (k - 50)::DOUBLE AS market_cap_change_24h,
    (k - 50) / 5.0::DOUBLE AS market_cap_change_pct_24h,
    value * 2000::DOUBLE AS fully_diluted_valuation,
    value * k::DOUBLE AS total_volume,
    CAST(k * 100 AS DOUBLE) AS circulating_supply,
    CAST(k * 110 AS DOUBLE) AS total_supply,
    CASE WHEN k >= 50 THEN CAST(k * 125 AS DOUBLE) END AS max_supply,
    value + 100 AS ath,
    k / 2.0::DOUBLE - 100 AS ath_change_pct,
    CASE WHEN k <> 42 THEN ts - INTERVAL 100 DAY END AS ath_date,
    value / 4 AS atl,
    k * 1.5::DOUBLE AS atl_change_pct,
    ts - INTERVAL 900 DAY AS atl_date,
    ts AS last_updated
  FROM events_k)"""

DERIVED = """
derived AS (
  SELECT *, high_24h - low_24h AS price_range_24h,
    CASE WHEN market_cap > 0 THEN total_volume / market_cap END AS volume_to_market_cap_ratio,
    price_change_pct_24h > 0 AS is_bullish_24h,
    year(batch_ingested_at) AS year, month(batch_ingested_at) AS month,
    day(batch_ingested_at) AS day, hour(batch_ingested_at) AS hour
  FROM flat)"""

VALID = "coin_id IS NOT NULL AND symbol IS NOT NULL AND market_cap IS NOT NULL AND current_price > 0"

DEDUPED = """
deduped AS (
  SELECT * FROM derived
  QUALIFY row_number() OVER (PARTITION BY ingestion_id, coin_id ORDER BY last_updated DESC) = 1)"""

SILVER = f"silver AS (SELECT * FROM deduped WHERE {VALID})"

# Surrogate keys count up over digest buckets, then over natural keys.
GOLD = """
coins AS (
  SELECT * FROM silver
  QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY batch_ingested_at DESC, last_updated DESC) = 1),
hours AS (
  SELECT DISTINCT
    CAST(strftime(date_trunc('hour', batch_ingested_at), '%Y%m%d%H') AS BIGINT) AS date_sk,
    date_trunc('hour', batch_ingested_at) AS snapshot_hour,
    dayofweek(batch_ingested_at) IN (0, 6) AS is_weekend
  FROM silver),
fact AS (
  SELECT s.* EXCLUDE (symbol, name), s.coin_id || '_' || s.ingestion_id AS snapshot_id,
    c.symbol, c.name, h.date_sk, h.snapshot_hour, h.is_weekend
  FROM silver s JOIN coins c USING (coin_id)
  JOIN hours h ON h.snapshot_hour = date_trunc('hour', s.batch_ingested_at)),
latest AS (SELECT * FROM fact WHERE batch_ingested_at = (SELECT max(batch_ingested_at) FROM fact))"""

# The same shape out of line items.
LINES = """
fact AS (
  SELECT l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS snapshot_id,
    l_partkey AS coin_sk, CAST(l_partkey AS VARCHAR) AS coin_id, p_name AS name, p_brand AS symbol,
    CAST(l_orderkey AS VARCHAR) AS ingestion_id, l_shipdate AS batch_ingested_at,
    date_trunc('hour', l_shipdate) AS snapshot_hour,
    CAST(strftime(l_shipdate, '%Y%m%d%H') AS BIGINT) AS date_sk,
    dayofweek(l_shipdate) IN (0, 6) AS is_weekend,
    l_extendedprice AS current_price, l_quantity AS total_volume, l_extendedprice AS market_cap,
    l_quantity / l_extendedprice AS volume_to_market_cap_ratio,
    (0.05::DOUBLE - l_discount) * 100 AS price_change_pct_24h, l_returnflag = 'A' AS is_bullish_24h
  FROM lineitem JOIN part ON p_partkey = l_partkey),
latest AS (SELECT * FROM fact WHERE batch_ingested_at = (SELECT max(batch_ingested_at) FROM fact))"""

_SILVER_STEPS = f"{FLAT}, {DERIVED}, {DEDUPED}, {SILVER}"
_FLAT = f"WITH {FLAT} "
_DERIVED = f"WITH {FLAT}, {DERIVED} "
_DEDUPED = f"WITH {FLAT}, {DERIVED}, {DEDUPED} "
_SILVER = f"WITH {_SILVER_STEPS} "
_GOLD = f"WITH {_SILVER_STEPS}, {GOLD} "
_LINES = f"WITH {LINES} "

FLAT_COLUMNS = """ingestion_id, batch_ingested_at, coin_id, symbol, name, current_price, high_24h, low_24h,
  price_change_24h, price_change_pct_24h, price_change_pct_7d, market_cap, market_cap_rank,
  market_cap_change_24h, market_cap_change_pct_24h, fully_diluted_valuation, total_volume,
  circulating_supply, total_supply, max_supply, ath, ath_change_pct, ath_date, atl, atl_change_pct,
  atl_date, last_updated"""

STAGING = """coin_id, symbol, name, current_price, high_24h, low_24h, price_change_24h, price_change_pct_24h,
  price_change_pct_7d, price_range_24h, market_cap, market_cap_rank, market_cap_change_24h,
  market_cap_change_pct_24h, fully_diluted_valuation, total_volume, volume_to_market_cap_ratio,
  circulating_supply, total_supply, max_supply, ath, ath_change_pct, ath_date, atl, atl_change_pct,
  atl_date, is_bullish_24h, batch_ingested_at, last_updated, ingestion_id"""


def rounded(x: str, digits: int) -> str:
    """Halves away from zero, written like the library's rounding."""
    scale = f"{10 ** digits}::DOUBLE"
    return (f"CASE WHEN abs({x}) * {scale} < 9007199254740992 "
            f"THEN sign({x}) * floor(abs({x}) * {scale} + 0.5) / {scale} ELSE {x} END")


def significant(x: str, digits: int = 10) -> str:
    return f"CAST(printf('%.{digits - 1}e', ({x}) * 1.000000000003::DOUBLE) AS DOUBLE)"


def total(x: str) -> str:
    return significant(f"sum({x})")


def mean(x: str) -> str:
    return significant(f"avg({x})")


def _calendar(ts: str) -> str:
    return f"""
      CAST(strftime({ts}, '%Y%m%d%H') AS BIGINT) AS date_sk, {ts} AS snapshot_hour,
      CAST({ts} AS DATE) AS date_actual, year({ts}) AS year, quarter({ts}) AS quarter,
      month({ts}) AS month, strftime({ts}, '%b') AS month_name, day({ts}) AS day_of_month,
      dayofweek({ts}) AS day_of_week, strftime({ts}, '%a') AS day_name, hour({ts}) AS hour_of_day,
      dayofweek({ts}) IN (0, 6) AS is_weekend"""


# --- Data quality -------------------------------------------------------------


def _row_check(name, kind, column, failing, threshold, message, passed="failed = 0"):
    limit = "NULL" if threshold is None else threshold
    return f"""
      SELECT '{name}' AS check_name, '{column}' AS "column", '{kind}' AS check_type, {passed} AS passed,
        total AS total_records, failed AS failed_records, {rounded('pct', 4)} AS failure_pct,
        CAST({limit} AS DOUBLE) AS threshold, {message} AS message
      FROM (SELECT *, coalesce(failed * 100.0::DOUBLE / nullif(total, 0), 0) AS pct
            FROM (SELECT count(*) AS total, count(*) FILTER ({failing}) AS failed FROM checked))"""


def _two(x):
    return f"printf('%.2f', {rounded(x, 2)})"


def _not_null(c, pct):
    return _row_check(
        f"not_null_{c}", "NOT_NULL", c, f"{c} IS NULL", pct,
        f"failed || '/' || total || ' nulls (' || {_two('pct')} || '%) — threshold {pct}%'", f"pct <= {pct}")


def _greater(c, v):
    return _row_check(f"gt_{c}_{v}", "GREATER_THAN", c, f"{c} IS NULL OR {c} <= {v}", v,
                      f"failed || ' records where {c} <= {v}'")


def _at_least(c, v):
    return _row_check(f"gte_{c}_{v}", "GREATER_THAN_OR_EQUAL", c, f"{c} IS NULL OR {c} < {v}", v,
                      f"failed || ' records where {c} < {v}'")


def _in_range(c, low, high):
    return _row_check(f"range_{c}", "RANGE", c, f"{c} IS NULL OR {c} < {low} OR {c} > {high}", None,
                      f"failed || ' records outside [{low}, {high}] for {c}'")


def _no_duplicates(columns, pct):
    keys, label = ", ".join(columns), ", ".join(columns)
    return f"""
      SELECT 'no_duplicates_{'_'.join(columns)}' AS check_name, '{label}' AS "column",
        'NO_DUPLICATES' AS check_type, pct <= {pct} AS passed, total AS total_records,
        failed AS failed_records, {rounded('pct', 4)} AS failure_pct, CAST({pct} AS DOUBLE) AS threshold,
        failed || ' duplicate rows on [{label}] (' || {_two('pct')} || '%)' AS message
      FROM (SELECT *, coalesce(failed * 100.0::DOUBLE / nullif(total, 0), 0) AS pct FROM (
        SELECT count(*) AS total,
          count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM checked)) AS failed FROM checked))"""


def _unique_count(c, least):
    return f"""
      SELECT 'unique_count_{c}' AS check_name, '{c}' AS "column", 'UNIQUE_COUNT' AS check_type,
        n >= {least} AS passed, total AS total_records,
        CASE WHEN n >= {least} THEN 0 ELSE 1 END AS failed_records,
        CASE WHEN n >= {least} THEN 0.0::DOUBLE ELSE 100.0::DOUBLE END AS failure_pct,
        CAST({least} AS DOUBLE) AS threshold,
        n || ' distinct values in {c} (expected >= {least})' AS message
      FROM (SELECT (SELECT count(*) FROM (SELECT DISTINCT {c} FROM checked)) AS n,
                   (SELECT count(*) FROM checked) AS total)"""


def _fresh(c, lag_minutes, limit):
    ok = lag_minutes <= limit
    shown = f"{lag_minutes:.1f}"
    return f"""
      SELECT 'freshness_{c}' AS check_name, '{c}' AS "column", 'FRESHNESS' AS check_type,
        {ok} AS passed, count(*) AS total_records, {'0' if ok else 'count(*)'} AS failed_records,
        {'0.0' if ok else '100.0'}::DOUBLE AS failure_pct, CAST({limit} AS DOUBLE) AS threshold,
        'Latest record is {shown} min old (threshold: {limit} min)' AS message FROM checked"""


_REQUIRED = ["coin_id", "symbol", "name", "current_price", "market_cap", "total_volume"]


def _suite(max_null, max_dup, volume, lag):
    return [
        *[_not_null(c, max_null) for c in _REQUIRED],
        _greater("current_price", 0), volume("total_volume", 0), _greater("market_cap", 0),
        _in_range("price_change_pct_24h", -100.0, 10000.0),
        _no_duplicates(["coin_id", "batch_ingested_at"], max_dup),
        _unique_count("coin_id", 50), _fresh("batch_ingested_at", lag, 90),
    ]


def _checks(prefix, source, parts):
    return f"{prefix}, checked AS (SELECT * FROM {source}) " + " UNION ALL ".join(parts)


_SUITE_CHECKS = _suite(5.0, 1.0, _at_least, 61.5)
_VERDICTS = (f"{_SILVER}, checked AS (SELECT * FROM silver), verdicts AS ("
             + " UNION ALL ".join(_SUITE_CHECKS) + ") ")

# --- Gold ---------------------------------------------------------------------

_TWO_LOADS = _SILVER + """,
first_load AS (
  SELECT * FROM silver WHERE batch_ingested_at < TIMESTAMP '2024-01-16'
  QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY batch_ingested_at DESC, last_updated DESC) = 1),
second_load AS (
  SELECT * FROM silver
  QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY batch_ingested_at DESC, last_updated DESC) = 1),
dim AS (
  SELECT row_number() OVER (ORDER BY f.coin_id IS NULL, substring(md5(s.coin_id), 1, 3), s.coin_id) AS coin_sk,
    s.coin_id, s.symbol, s.name,
    CASE WHEN f.coin_id IS NULL THEN s.ath ELSE greatest(coalesce(f.ath, 0), coalesce(s.ath, 0)) END AS ath,
    CASE WHEN f.coin_id IS NULL THEN s.atl ELSE f.atl END AS atl,
    CASE WHEN f.coin_id IS NULL THEN s.ath_date ELSE f.ath_date END AS ath_date,
    CASE WHEN f.coin_id IS NULL THEN s.atl_date ELSE f.atl_date END AS atl_date,
    s.circulating_supply,
    CASE WHEN f.coin_id IS NULL THEN s.total_supply ELSE f.total_supply END AS total_supply,
    CASE WHEN f.coin_id IS NULL THEN s.max_supply ELSE f.max_supply END AS max_supply,
    TRUE AS is_active,
    CASE WHEN f.coin_id IS NULL THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-01' END AS first_seen_at,
    TIMESTAMP '2024-02-02' AS last_updated_at
  FROM second_load s LEFT JOIN first_load f USING (coin_id))
"""

_COUNTS = _GOLD + """
SELECT 'fact_market_snapshot' AS table_name, (SELECT count(*) FROM fact) AS row_count
UNION ALL SELECT 'dim_coin', (SELECT count(*) FROM coins)
UNION ALL SELECT 'dim_date', (SELECT count(*) FROM hours)"""

_PROMISES = {
    "dim_coin": [("NOT_NULL", c) for c in ("coin_sk", "coin_id", "symbol", "name")]
    + [("PRIMARY_KEY", "coin_sk"), ("UNIQUE", "coin_id")],
    "dim_date": [("NOT_NULL", c) for c in (
        "date_sk", "snapshot_hour", "date_actual", "year", "quarter", "month", "month_name",
        "day_of_month", "day_of_week", "day_name", "hour_of_day", "is_weekend")]
    + [("PRIMARY_KEY", "date_sk"), ("UNIQUE", "snapshot_hour")],
    "fact_market_snapshot": [("NOT_NULL", c) for c in (
        "snapshot_id", "coin_sk", "date_sk", "current_price", "batch_ingested_at")]
    + [("PRIMARY_KEY", "snapshot_id"), ("FOREIGN_KEY", "coin_sk"), ("FOREIGN_KEY", "date_sk")],
}


def _promise(table, kind, columns, count="0"):
    return (f"SELECT '{table}' AS table_name, '{kind}' AS constraint_type, "
            f"'{columns}' AS column_names, {count} AS violations")


# A load leaves no violation, whatever the data: each row is counted in the data it comes from.
_CONTRACTS = _GOLD + " UNION ALL ".join([
    _promise("dim_coin", "NOT_NULL", "coin_sk", "(SELECT count(*) FROM coins WHERE coin_id IS NULL)"),
    _promise("dim_coin", "NOT_NULL", "coin_id", "(SELECT count(*) FROM coins WHERE coin_id IS NULL)"),
    _promise("dim_coin", "NOT_NULL", "symbol", "(SELECT count(*) FROM coins WHERE symbol IS NULL)"),
    _promise("dim_coin", "NOT_NULL", "name", "(SELECT count(*) FROM coins WHERE name IS NULL)"),
    _promise("dim_coin", "PRIMARY_KEY", "coin_sk",
             "(SELECT count(*) - count(DISTINCT coin_id) FROM coins)"),
    _promise("dim_coin", "UNIQUE", "coin_id", "(SELECT count(*) - count(DISTINCT coin_id) FROM coins)"),
    *[_promise("dim_date", k, c, "(SELECT count(*) - count(DISTINCT date_sk) FROM hours)")
      for k, c in _PROMISES["dim_date"]],
    *[_promise("fact_market_snapshot", k, c, "(SELECT count(*) - count(DISTINCT snapshot_id) FROM fact)")
      for k, c in _PROMISES["fact_market_snapshot"]],
])

_BULLISH = "(SELECT count(*) FROM fact WHERE is_bullish_24h)"
_CLICKS = "(SELECT count(*) FROM coins WHERE symbol = 'click')"
_WEEKENDS = "(SELECT count(*) FROM hours WHERE is_weekend)"
_EXPECTED = {
    ("fact_market_snapshot", "NOT_NULL", "current_price"): _BULLISH,
    ("fact_market_snapshot", "PRIMARY_KEY", "snapshot_id"): _BULLISH,
    ("fact_market_snapshot", "FOREIGN_KEY", "coin_sk"): _BULLISH,
    ("fact_market_snapshot", "FOREIGN_KEY", "date_sk"): _BULLISH,
    ("dim_coin", "NOT_NULL", "name"): _CLICKS, ("dim_coin", "PRIMARY_KEY", "coin_sk"): _CLICKS,
    ("dim_coin", "UNIQUE", "coin_id"): _CLICKS, ("dim_date", "NOT_NULL", "day_name"): _WEEKENDS,
    ("dim_date", "PRIMARY_KEY", "date_sk"): _WEEKENDS, ("dim_date", "UNIQUE", "snapshot_hour"): _WEEKENDS,
}
_BROKEN = _GOLD + " UNION ALL ".join(
    _promise(t, k, c, _EXPECTED.get((t, k, c), "0")) for t, kinds in _PROMISES.items() for k, c in kinds)

_ORPHANS = _LINES + " UNION ALL ".join(
    [_promise("fact_market_snapshot", "NOT_NULL", c, f"(SELECT count(*) FROM fact WHERE {c} IS NULL)")
     for c in ("snapshot_id", "coin_sk", "date_sk", "current_price", "batch_ingested_at")]
    + [
        _promise("fact_market_snapshot", "PRIMARY_KEY", "snapshot_id",
                 "(SELECT count(*) - count(DISTINCT snapshot_id) FROM fact)"),
        _promise("fact_market_snapshot", "FOREIGN_KEY", "coin_sk",
                 "(SELECT count(*) FROM fact WHERE symbol = 'Brand#1')"),
        _promise("fact_market_snapshot", "FOREIGN_KEY", "date_sk"),
    ])

# --- Reports ------------------------------------------------------------------

_TOP_VOLUME = f"""
SELECT name AS coin_name, symbol, current_price, total_volume, market_cap,
  {rounded('volume_to_market_cap_ratio * 100', 2)} AS volume_to_mcap_pct, price_change_pct_24h
FROM latest ORDER BY total_volume DESC NULLS LAST, coin_id LIMIT 10"""

_VOLATILITY = f"""
SELECT name, symbol, current_price, price_range_24h,
  {rounded('price_range_24h / nullif(current_price, 0) * 100', 2)} AS volatility_pct,
  rank() OVER (ORDER BY price_range_24h / nullif(current_price, 0) DESC NULLS LAST) AS volatility_rank
FROM latest WHERE current_price > 0"""

_CAP_RANK = """
SELECT name, symbol, current_price, market_cap, total_volume, price_change_pct_24h,
  rank() OVER (ORDER BY market_cap DESC NULLS LAST) AS rank
FROM latest"""


def _trend(interval, avg):
    return f"""
SELECT snapshot_hour, year(snapshot_hour) AS year, month(snapshot_hour) AS month,
  day(snapshot_hour) AS day_of_month, hour(snapshot_hour) AS hour_of_day,
  count(DISTINCT coin_id) AS coins_tracked, {total('market_cap')} AS total_market_cap_usd,
  {total('total_volume')} AS total_volume_usd, {avg} AS avg_price_change_pct,
  count(*) FILTER (is_bullish_24h) AS bullish_coins, count(*) FILTER (NOT is_bullish_24h) AS bearish_coins
FROM fact
WHERE snapshot_hour >= (SELECT max(batch_ingested_at) FROM fact) + INTERVAL 1 HOUR - INTERVAL {interval}
GROUP BY snapshot_hour"""


_HISTORY_KEY = "PARTITION BY coin_id ORDER BY batch_ingested_at, snapshot_id"


def _change(where, following=""):
    delta = "(current_price - coalesce(prev_price, current_price))"
    return f"""
SELECT name, symbol, batch_ingested_at, current_price, prev_price, {following}
  {rounded(delta, 4)} AS price_delta,
  {rounded(f'{delta} / nullif(prev_price, 0) * 100', 4)} AS pct_change_from_prev_snapshot
FROM (SELECT *, lag(current_price) OVER ({_HISTORY_KEY}) AS prev_price,
        lead(current_price) OVER ({_HISTORY_KEY}) AS next_price
      FROM fact WHERE {where})"""


def _rolling(where):
    return f"""
SELECT name, symbol, batch_ingested_at, current_price, {rounded('mean', 6)} AS rolling_24h_avg_price,
  {rounded('current_price - mean', 6)} AS deviation_from_rolling_avg
FROM (SELECT *, avg(current_price) OVER ({_HISTORY_KEY} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS mean
      FROM fact WHERE {where})"""


def _rolling_time(seconds):
    frame = f"RANGE BETWEEN INTERVAL '{seconds - 1}' SECOND PRECEDING AND CURRENT ROW"
    return f"""
SELECT name, symbol, batch_ingested_at, current_price, snapshots, {rounded('mean', 6)} AS day_avg_price,
  {rounded('current_price - mean', 6)} AS deviation_from_day_avg
FROM (SELECT *, avg(current_price) OVER w AS mean, count(*) OVER w AS snapshots
      FROM fact WINDOW w AS (PARTITION BY coin_id ORDER BY batch_ingested_at {frame}))"""


_DOMINANCE = f"""
SELECT name, symbol, market_cap, dominance_pct,
  CAST(sum(CAST(dominance_pct AS DECIMAL(20,4))) OVER (
    ORDER BY market_cap DESC NULLS LAST, coin_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative_dominance_pct
FROM (SELECT *, {rounded('market_cap / total * 100', 4)} AS dominance_pct
      FROM latest, (SELECT sum(market_cap) AS total FROM latest))"""

_WEEKEND = f"""
SELECT name, symbol, {significant('weekend')} AS avg_weekend_volume, {significant('weekday')} AS avg_weekday_volume,
  {rounded('(weekend / nullif(weekday, 0) - 1) * 100', 2)} AS weekend_vs_weekday_pct_diff
FROM (
  SELECT name, symbol, avg(CASE WHEN is_weekend THEN total_volume END) AS weekend,
    avg(CASE WHEN NOT is_weekend THEN total_volume END) AS weekday
  FROM fact GROUP BY name, symbol HAVING count(*) >= 10)
ORDER BY abs(weekend_vs_weekday_pct_diff) DESC NULLS LAST, name, symbol LIMIT 20"""


def _freshness(interval):
    return f"""
SELECT last_ingestion_time, now, lag_minutes, total_batches, total_records, distinct_coins, earliest_record,
  CASE WHEN lag_minutes <= 90 THEN '✅ FRESH' ELSE '⚠️ STALE — Check Poller' END AS pipeline_status
FROM (SELECT max(batch_ingested_at) AS last_ingestion_time,
        max(batch_ingested_at) + INTERVAL '{interval}' AS now,
        date_diff('minute', max(batch_ingested_at), max(batch_ingested_at) + INTERVAL '{interval}') AS lag_minutes,
        count(DISTINCT ingestion_id) AS total_batches, count(*) AS total_records,
        count(DISTINCT coin_id) AS distinct_coins, min(batch_ingested_at) AS earliest_record
      FROM fact)"""


_SYMBOLS = "symbol IN ('click', 'view', 'purchase')"
_NEXT = "next_price,"


def _distribution(missing):
    return _SILVER + f"""
SELECT price_bucket, bucket_index, count(*) AS coin_count, {mean('price_change_pct_24h')} AS avg_pct_change
FROM (SELECT price_change_pct_24h,
  CASE WHEN price_change_pct_24h >= 10 THEN '🚀 > +10%' WHEN price_change_pct_24h >= 5 THEN '📈 +5% to +10%'
    WHEN price_change_pct_24h >= 0 THEN '🟢 0% to +5%' WHEN price_change_pct_24h >= -5 THEN '🔴 -5% to 0%'
    WHEN price_change_pct_24h IS NOT NULL THEN '💀 < -5%' ELSE '{missing[0]}' END AS price_bucket,
  CASE WHEN price_change_pct_24h >= 10 THEN 0 WHEN price_change_pct_24h >= 5 THEN 1
    WHEN price_change_pct_24h >= 0 THEN 2 WHEN price_change_pct_24h >= -5 THEN 3
    WHEN price_change_pct_24h IS NOT NULL THEN 4 ELSE {missing[1]} END AS bucket_index
  FROM silver) GROUP BY ALL"""


_SNAPSHOT = "ingestion_id, coin_id, symbol, current_price, total_volume, last_updated"
_VALIDITY = "ingestion_id, coin_id, symbol, current_price, market_cap, last_updated"


def oracles() -> dict[str, str]:
    return {
        "bronze_explode_flatten": _FLAT + f"SELECT {FLAT_COLUMNS} FROM flat",
        "bronze_envelopes": _FLAT + """
            SELECT ingestion_id, 'test_events' AS source,
              strftime(batch_ingested_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingested_at,
              count(*) AS record_count, count(*) AS data_records, 0 AS corrupt_envelopes
            FROM flat GROUP BY ingestion_id, batch_ingested_at""",
        "bronze_since_until": _FLAT + """
            SELECT ingestion_id, coin_id, symbol, current_price, last_updated FROM flat
            WHERE batch_ingested_at >= TIMESTAMP '2024-01-10' AND batch_ingested_at < TIMESTAMP '2024-01-20 12:00:00'""",
        "bronze_damaged": _DEDUPED + f"""
            SELECT count(*) AS seen, count(*) FILTER ({VALID}) AS kept, TRUE AS all_damage_counted
            FROM deduped WHERE ingestion_id NOT LIKE '%06'""",
        "bronze_to_silver": _SILVER + "SELECT * FROM silver",
        "record_fields": _FLAT + """
            SELECT CASE WHEN k <> 98 THEN CAST(user_id AS VARCHAR) END AS coin_id, 'user-' || user_id AS name,
              CASE WHEN event_type = 'error' AND k < 50 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS current_price,
              CASE WHEN k >= 3 THEN CAST(value * (1000 + k)::DOUBLE AS VARCHAR) END AS market_cap,
              CAST(value * k::DOUBLE AS VARCHAR) AS total_volume FROM events_k""",
        "silver_derived": _DERIVED + """
            SELECT ingestion_id, coin_id, last_updated, price_range_24h, volume_to_market_cap_ratio,
              is_bullish_24h, year, month, day, hour FROM derived""",
        "silver_dedup": _DEDUPED + f"SELECT {_SNAPSHOT} FROM deduped",
        "silver_dedup_aggregate": _DEDUPED + f"SELECT {_SNAPSHOT} FROM deduped",
        "event_dedup": """
            SELECT *, date_trunc('hour', ts) AS hour FROM events
            QUALIFY row_number() OVER (
              PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1""",
        "silver_filter_invalid": _DERIVED + f"SELECT {_VALIDITY} FROM derived WHERE {VALID}",
        "silver_rejected": _DERIVED + f"SELECT {_VALIDITY} FROM derived WHERE NOT coalesce({VALID}, FALSE)",
        "silver_partitioned_roundtrip": _SILVER + "SELECT * FROM silver",
        "silver_since_until": _SILVER + """
            SELECT ingestion_id, coin_id, batch_ingested_at, current_price, year, month, day, hour FROM silver
            WHERE batch_ingested_at >= TIMESTAMP '2024-01-10' AND batch_ingested_at < TIMESTAMP '2024-01-20 12:00:00'""",
        "silver_append_twice": _SILVER + "SELECT ingestion_id, coin_id, current_price, last_updated FROM silver",
        "silver_preview": _SILVER + """
            SELECT coin_id, symbol, name, current_price, market_cap, total_volume, price_change_pct_24h,
              is_bullish_24h, batch_ingested_at
            FROM silver ORDER BY market_cap_rank, batch_ingested_at DESC, coin_id LIMIT 15""",
        "dq_suite": _VERDICTS + "SELECT * FROM verdicts",
        "dq_suite_from_states": _VERDICTS + "SELECT * FROM verdicts",
        "dq_suite_raw": _checks(_DERIVED, "derived", _suite(2.5, 0.5, _greater, 95)),
        "dq_configured_rules": _checks(_DERIVED, "derived", [
            _not_null("current_price", 5.0), _greater("current_price", 0), _not_null("coin_id", 5.0),
            _not_null("market_cap", 5.0), _greater("total_volume", 0)]),
        "dq_report": _VERDICTS + """
            SELECT 'silver_layer' AS dataset, count(*) AS total_checks, count(*) FILTER (passed) AS passed,
              count(*) FILTER (NOT passed) AS failed, bool_and(passed) AS overall_pass, count(*) AS result_count
            FROM verdicts""",
        "dq_summary_lines": _VERDICTS + """
            SELECT CASE WHEN passed THEN '✅' ELSE '❌' END || ' [' || check_type || '] ' || "column" || ': '
              || message AS line FROM verdicts""",
        "dq_null_summary": _DERIVED + f"""
            SELECT count(*) AS total_records, count(*) FILTER (current_price IS NULL) AS null_price_count,
              count(*) FILTER (market_cap IS NULL) AS null_mktcap_count,
              count(*) FILTER (coin_id IS NULL) AS null_coinid_count,
              count(*) FILTER (is_bullish_24h) AS bullish_coins,
              {mean('price_change_pct_24h')} AS avg_24h_change_pct, count(coin_id) AS non_null_coins
            FROM derived""",
        "null_counts": _DERIVED + "SELECT " + ", ".join(
            f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in (
                "coin_id", "symbol", "current_price", "high_24h", "market_cap", "max_supply", "ath_date",
                "price_change_pct_24h")) + " FROM derived",
        "dataset_summary": _SILVER + f"""
            SELECT count(*) AS total_records, count(DISTINCT coin_id) AS unique_coins,
              count(DISTINCT ingestion_id) AS total_batches, {mean('current_price')} AS avg_price_usd,
              {total('market_cap')} AS total_market_cap, {total('total_volume')} AS total_volume_usd,
              count(*) FILTER (is_bullish_24h) AS bullish_count,
              count(*) FILTER (NOT is_bullish_24h) AS bearish_count,
              max(batch_ingested_at) AS latest_ingestion, min(batch_ingested_at) AS earliest_ingestion
            FROM silver""",
        "change_distribution": _distribution(("unknown", 5)),
        "change_distribution_missing_lowest": _distribution(("💀 < -5%", 4)),
        "distinct_incl_null": _FLAT + """
            SELECT count(*) AS total_rows,
              (SELECT count(*) FROM (SELECT DISTINCT coin_id FROM flat)) AS distinct_coins,
              (SELECT count(*) FROM (SELECT DISTINCT symbol FROM flat)) AS distinct_symbols,
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT coin_id, batch_ingested_at FROM flat))
                AS duplicate_rows
            FROM flat""",
        "staging_projection": _SILVER + "SELECT " + ", ".join(
            f'{c.strip()} AS "{c.strip().upper()}"' for c in STAGING.split(",")) + " FROM silver",
        "table_sink": _SILVER + "SELECT coin_id, ingestion_id, market_cap, ath_date, is_bullish_24h FROM silver",
        "dim_date_build": _SILVER + f"SELECT DISTINCT {_calendar('batch_ingested_at')} FROM silver",
        "dim_date_of_orders": f"SELECT DISTINCT {_calendar('o_orderdate')} FROM orders",
        "dim_entity_upsert": _TWO_LOADS + "SELECT * FROM dim",
        "fact_load_incremental": _TWO_LOADS + """
            SELECT s.coin_id || '_' || s.ingestion_id AS snapshot_id, d.coin_sk,
              CAST(strftime(s.batch_ingested_at, '%Y%m%d%H') AS BIGINT) AS date_sk, s.ingestion_id,
              s.current_price, s.high_24h, s.low_24h, s.price_change_24h, s.price_change_pct_24h,
              s.price_change_pct_7d, s.price_range_24h, s.market_cap, s.market_cap_rank,
              s.market_cap_change_24h, s.market_cap_change_pct_24h, s.fully_diluted_valuation,
              s.total_volume, s.volume_to_market_cap_ratio, s.ath_change_pct, s.atl_change_pct,
              s.is_bullish_24h, s.batch_ingested_at, s.last_updated,
              CASE WHEN s.batch_ingested_at < TIMESTAMP '2024-01-16' THEN TIMESTAMP '2024-02-01'
                ELSE TIMESTAMP '2024-02-02' END AS loaded_at,
              CAST(s.batch_ingested_at AS DATE) AS snapshot_date
            FROM silver s JOIN dim d USING (coin_id)""",
        "fact_load_duplicates": _DERIVED + f"""
            SELECT coin_id || '_' || ingestion_id AS snapshot_id,
              CAST(strftime(batch_ingested_at, '%Y%m%d%H') AS BIGINT) AS date_sk, current_price,
              total_volume, last_updated
            FROM derived WHERE {VALID}
            QUALIFY row_number() OVER (PARTITION BY ingestion_id, coin_id ORDER BY last_updated DESC) = 1""",
        "quarantined_rows": _FLAT + """
            SELECT coin_id, ingestion_id, symbol, current_price, last_updated FROM flat
            WHERE coin_id IS NULL OR symbol IS NULL OR current_price IS NULL""",
        "quarantine_reasons": _FLAT + " UNION ALL ".join(
            f"SELECT '{c}' AS missing_column, count(*) FILTER ({c} IS NULL) AS rows FROM flat"
            for c in ("coin_id", "ingestion_id", "batch_ingested_at", "symbol", "name", "current_price")),
        "fact_redelivered": _GOLD + """
            SELECT snapshot_id, date_sk, batch_ingested_at, current_price,
              CAST(batch_ingested_at AS DATE) AS snapshot_date FROM fact""",
        "contract_violations_broken": _BROKEN,
        "small_amounts": f"""
            SELECT event_type, {total('value * 1e-10')} AS total_amount, {mean('value * 1e-10')} AS mean_amount
            FROM events GROUP BY event_type""",
        "silver_to_gold": _COUNTS,
        "table_counts": _COUNTS,
        "contract_violations": _CONTRACTS,
        "fact_orphans": _ORPHANS,
        "top_volume": _GOLD + _TOP_VOLUME,
        "volatility_rank": _GOLD + f"""
            SELECT * EXCLUDE (coin_id) FROM (
              {_VOLATILITY.replace('SELECT name,', 'SELECT coin_id, name,', 1)})
            ORDER BY volatility_rank, coin_id LIMIT 20""",
        "volatility_rank_all": _GOLD + _VOLATILITY,
        "hourly_trend": _GOLD + _trend("7 DAY", mean("price_change_pct_24h")),
        "snapshot_change": _GOLD + _change(_SYMBOLS),
        "snapshot_change_all": _GOLD + _change("TRUE", _NEXT),
        "snapshot_change_sliced": _GOLD + _change("TRUE", _NEXT),
        "dominance": _GOLD + _DOMINANCE + " ORDER BY dominance_pct DESC NULLS LAST, market_cap DESC, coin_id LIMIT 15",
        "dominance_all": _GOLD + _DOMINANCE,
        "weekend_weekday": _GOLD + _WEEKEND,
        "rolling_average": _GOLD + _rolling(_SYMBOLS),
        "rolling_average_sliced": _GOLD + _rolling("TRUE"),
        "freshness_monitor": _GOLD + _freshness("89 minutes 59 seconds"),
        "freshness_monitor_stale": _GOLD + _freshness("91 minutes"),
        "marketcap_rank": _GOLD + _CAP_RANK + " ORDER BY rank, coin_id LIMIT 15",
        "marketcap_rank_all": _GOLD + _CAP_RANK,
        "line_hourly_trend": _LINES + _trend("365 DAY", rounded("avg(price_change_pct_24h)", 6)),
        "snapshot_change_bucketed": _GOLD + _change("TRUE", _NEXT),
        "rolling_day_average": _GOLD + _rolling_time(86_400),
        "line_rolling_week_average": _LINES + _rolling_time(7 * 86_400),
        "distinct_entities_by_day": _GOLD + """
            SELECT CAST(batch_ingested_at AS DATE) AS snapshot_date, count(*) AS rows,
              count(DISTINCT coin_id) AS exact_entities, TRUE AS estimate_within_bounds
            FROM fact GROUP BY CAST(batch_ingested_at AS DATE)""",
        "distinct_parts_by_month": _LINES + """
            SELECT CAST(date_trunc('month', batch_ingested_at) AS DATE) AS month, count(*) AS rows,
              count(DISTINCT coin_id) AS exact_parts, TRUE AS estimate_within_bounds
            FROM fact GROUP BY date_trunc('month', batch_ingested_at)""",
        "line_weekend_weekday": _LINES + _WEEKEND,
        "line_rolling_average": _LINES + _rolling("TRUE"),
        "line_snapshot_change": _LINES + _change("symbol IN ('Brand#1', 'Brand#2', 'Brand#3')"),
        "line_top_volume": _LINES + _TOP_VOLUME,
        "line_freshness": _LINES + _freshness("2 hours"),
        "stream_first_seen": _DERIVED + f"""
            SELECT DISTINCT ingestion_id, coin_id FROM derived WHERE {VALID}""",
        "stream_first_seen_within": _DERIVED + f""",
            placed AS (
              SELECT *, CASE WHEN last_updated < TIMESTAMP '2024-01-11' THEN 1
                WHEN last_updated < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS own, second(last_updated) AS s
              FROM derived WHERE {VALID}),
            arrived AS (
              SELECT ingestion_id, coin_id, batch_ingested_at, own AS wave FROM placed WHERE s % 7 <> 0
              UNION ALL SELECT ingestion_id, coin_id, batch_ingested_at, own + 1 FROM placed
              WHERE s % 7 = 0 OR s % 5 = 0),
            marks AS (
              SELECT w.wave, max(a.batch_ingested_at) - INTERVAL 3 DAY AS mark
              FROM (SELECT DISTINCT wave FROM arrived) w LEFT JOIN arrived a ON a.wave < w.wave GROUP BY w.wave)
            SELECT DISTINCT ingestion_id, coin_id, batch_ingested_at FROM arrived JOIN marks USING (wave)
            WHERE mark IS NULL OR batch_ingested_at > mark""",
        "stream_hourly_trend": _SILVER + f"""
            SELECT date_trunc('hour', batch_ingested_at) AS snapshot_hour, count(DISTINCT coin_id) AS coins_tracked,
              {total('market_cap')} AS total_market_cap_usd, {total('total_volume')} AS total_volume_usd,
              {mean('price_change_pct_24h')} AS avg_price_change_pct,
              count(*) FILTER (is_bullish_24h) AS bullish_coins, count(*) FILTER (NOT is_bullish_24h) AS bearish_coins
            FROM silver GROUP BY date_trunc('hour', batch_ingested_at)""",
        "stream_landing": _DERIVED + f"""
            SELECT ingestion_id, coin_id, current_price, last_updated, TRUE AS all_damage_kept
            FROM derived WHERE {VALID} AND NOT ends_with(ingestion_id, '06')
            QUALIFY row_number() OVER (PARTITION BY ingestion_id, coin_id ORDER BY last_updated DESC) = 1""",
        "stream_keep_latest": _DERIVED + f"""
            SELECT {_SNAPSHOT} FROM derived WHERE {VALID}
            QUALIFY row_number() OVER (PARTITION BY ingestion_id, coin_id ORDER BY last_updated DESC) = 1""",
        "stream_gold": _GOLD + "SELECT snapshot_id, coin_id, date_sk, current_price, market_cap, last_updated FROM fact",
        "time_functions": """
            SELECT event_id, CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS date_sk, year(ts) AS year,
              month(ts) AS month, day(ts) AS day, hour(ts) AS hour, quarter(ts) AS quarter,
              strftime(ts, '%a') AS day_name, strftime(ts, '%b') AS month_name,
              dayofweek(ts) IN (0, 6) AS is_weekend,
              date_diff('minute', ts, TIMESTAMP '2024-02-01 00:00:30') AS minutes FROM events""",
        "neighbours_of_orders": """
            SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice,
              lag(o_totalprice) OVER w AS prev_total, lead(o_totalprice) OVER w AS next_total
            FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    }
