"""Record shape, column mappings and table contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- Fixed values: names, types and order of the data model -------------------

# (silver column, field of the raw record, type)
RECORD_COLUMNS = (
    ("coin_id", "id", "string"),
    ("symbol", "symbol", "string"),
    ("name", "name", "string"),
    ("current_price", "current_price", "double"),
    ("high_24h", "high_24h", "double"),
    ("low_24h", "low_24h", "double"),
    ("price_change_24h", "price_change_24h", "double"),
    ("price_change_pct_24h", "price_change_percentage_24h", "double"),
    ("price_change_pct_7d", "price_change_percentage_7d_in_currency", "double"),
    ("market_cap", "market_cap", "double"),
    ("market_cap_rank", "market_cap_rank", "bigint"),
    ("market_cap_change_24h", "market_cap_change_24h", "double"),
    ("market_cap_change_pct_24h", "market_cap_change_percentage_24h", "double"),
    ("fully_diluted_valuation", "fully_diluted_valuation", "double"),
    ("total_volume", "total_volume", "double"),
    ("circulating_supply", "circulating_supply", "double"),
    ("total_supply", "total_supply", "double"),
    ("max_supply", "max_supply", "double"),
    ("ath", "ath", "double"),
    ("ath_change_pct", "ath_change_percentage", "double"),
    ("ath_date", "ath_date", "timestamp"),
    ("atl", "atl", "double"),
    ("atl_change_pct", "atl_change_percentage", "double"),
    ("atl_date", "atl_date", "timestamp"),
    ("last_updated", "last_updated", "timestamp"),
)

# Fields of the raw record that silver does not keep.
UNUSED_RECORD_FIELDS = ("image",)

DERIVED_COLUMNS = (
    ("price_range_24h", "double"),
    ("volume_to_market_cap_ratio", "double"),
    ("is_bullish_24h", "boolean"),
)

PARTITION_COLUMNS = ("year", "month", "day", "hour")

STAGING_COLUMNS = (
    "coin_id", "symbol", "name",
    "current_price", "high_24h", "low_24h",
    "price_change_24h", "price_change_pct_24h", "price_change_pct_7d",
    "price_range_24h", "market_cap", "market_cap_rank",
    "market_cap_change_24h", "market_cap_change_pct_24h",
    "fully_diluted_valuation", "total_volume", "volume_to_market_cap_ratio",
    "circulating_supply", "total_supply", "max_supply",
    "ath", "ath_change_pct", "ath_date",
    "atl", "atl_change_pct", "atl_date",
    "is_bullish_24h", "batch_ingested_at", "last_updated", "ingestion_id",
)

STAGING_TIMESTAMPS = ("batch_ingested_at", "last_updated", "ath_date", "atl_date")

FACT_MEASURES = (
    "current_price", "high_24h", "low_24h",
    "price_change_24h", "price_change_pct_24h", "price_change_pct_7d", "price_range_24h",
    "market_cap", "market_cap_rank", "market_cap_change_24h", "market_cap_change_pct_24h",
    "fully_diluted_valuation", "total_volume", "volume_to_market_cap_ratio",
    "ath_change_pct", "atl_change_pct", "is_bullish_24h",
)

DIM_COIN = "dim_coin"
DIM_DATE = "dim_date"
FACT = "fact_market_snapshot"

# --- End of fixed values ------------------------------------------------------

# The one partition column of the stored fact; it is derived from the batch time.
FACT_PARTITION = "snapshot_date"

CORRUPT = "_corrupt_record"


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(),
    "int": T.IntegerType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(), "date": T.DateType(),
}


def _struct(*fields: tuple[str, str] | tuple[str, str, bool]) -> T.StructType:
    schema = T.StructType()
    for name, kind, *required in fields:
        schema = schema.add(name, _TYPES[kind], not (required and required[0]))
    return schema


def record_schema() -> T.StructType:
    """Raw record with text leaves, so one malformed value cannot spoil its batch."""
    names = [source for _, source, _ in RECORD_COLUMNS] + list(UNUSED_RECORD_FIELDS)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def envelope_schema() -> T.StructType:
    return T.StructType([
        T.StructField("ingestion_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("ingested_at", T.StringType()),
        T.StructField("record_count", T.StringType()),
        T.StructField("data", T.ArrayType(record_schema())),
        T.StructField(CORRUPT, T.StringType()),
    ])


def damaged_schema() -> T.StructType:
    return T.StructType([T.StructField("ingestion_id", T.StringType()), T.StructField(CORRUPT, T.StringType())])


def silver_schema() -> T.StructType:
    kinds = {"ingestion_id": "string", "batch_ingested_at": "timestamp"}
    kinds.update({name: kind for name, _, kind in RECORD_COLUMNS})
    kinds.update(dict(DERIVED_COLUMNS))
    kinds.update({name: "int" for name in PARTITION_COLUMNS})
    return T.StructType([T.StructField(n, _TYPES[k]) for n, k in kinds.items()])


def staging_schema() -> T.StructType:
    silver = silver_schema()
    return T.StructType([silver[name] for name in STAGING_COLUMNS])


# Default of a column that holds when its row was loaded.
LOAD_TIME = "load time"


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    references: str


@dataclass(frozen=True)
class TableContract:
    """Columns, keys and defaults a stored table promises."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    defaults: dict = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


DIM_COIN_CONTRACT = TableContract(
    name=DIM_COIN,
    schema=_struct(
        ("coin_sk", "bigint", True), ("coin_id", "string", True),
        ("symbol", "string", True), ("name", "string", True),
        ("ath", "double"), ("atl", "double"),
        ("ath_date", "timestamp"), ("atl_date", "timestamp"),
        ("circulating_supply", "double"), ("total_supply", "double"), ("max_supply", "double"),
        ("is_active", "boolean"), ("first_seen_at", "timestamp"), ("last_updated_at", "timestamp"),
    ),
    primary_key=("coin_sk",),
    unique=(("coin_id",),),
    defaults={"is_active": True, "first_seen_at": LOAD_TIME, "last_updated_at": LOAD_TIME},
)

DIM_DATE_CONTRACT = TableContract(
    name=DIM_DATE,
    schema=_struct(
        ("date_sk", "bigint", True), ("snapshot_hour", "timestamp", True),
        ("date_actual", "date", True), ("year", "int", True), ("quarter", "int", True),
        ("month", "int", True), ("month_name", "string", True), ("day_of_month", "int", True),
        ("day_of_week", "int", True), ("day_name", "string", True),
        ("hour_of_day", "int", True), ("is_weekend", "boolean", True),
    ),
    primary_key=("date_sk",),
    unique=(("snapshot_hour",),),
)

_SILVER_KINDS = {f.name: f.dataType.simpleString() for f in silver_schema()}

FACT_CONTRACT = TableContract(
    name=FACT,
    schema=_struct(
        ("snapshot_id", "string", True), ("coin_sk", "bigint", True),
        ("date_sk", "bigint", True), ("ingestion_id", "string"),
        *[(m, _SILVER_KINDS[m], m == "current_price") for m in FACT_MEASURES],
        ("batch_ingested_at", "timestamp", True), ("last_updated", "timestamp"),
        ("loaded_at", "timestamp"),
    ),
    primary_key=("snapshot_id",),
    foreign_keys=(
        ForeignKey("coin_sk", DIM_COIN, "coin_sk"),
        ForeignKey("date_sk", DIM_DATE, "date_sk"),
    ),
    defaults={"loaded_at": LOAD_TIME},
    cluster_by=("date_sk", "coin_sk"),
)

CONTRACTS = {c.name: c for c in (DIM_COIN_CONTRACT, DIM_DATE_CONTRACT, FACT_CONTRACT)}
