"""Hand-made records and batches."""

import json
import os

RECORD = {
    "id": "aa", "symbol": "a", "name": "Alpha", "image": "http://x/a.png",
    "current_price": 10.5, "market_cap": 1000, "market_cap_rank": 1,
    "fully_diluted_valuation": 1200, "total_volume": 50.25, "high_24h": 12, "low_24h": 9.5,
    "price_change_24h": 0.5, "price_change_percentage_24h": 5.0,
    "price_change_percentage_7d_in_currency": -2.0, "market_cap_change_24h": 10,
    "market_cap_change_percentage_24h": 1.0, "circulating_supply": 100, "total_supply": 110,
    "max_supply": None, "ath": 20, "ath_change_percentage": -50, "ath_date": "2023-01-01T00:00:00.000Z",
    "atl": 1, "atl_change_percentage": 950, "atl_date": "2020-01-01T00:00:00+00:00",
    "last_updated": "2024-06-15T10:05:00.123Z",
}


def record(**changes):
    return {**RECORD, **changes}


def envelope(batch, at, records, **more):
    return {"ingestion_id": batch, "source": "test", "ingested_at": at,
            "record_count": len(records or []), **more, "data": records}


def put(folder, name, document, indent=2):
    os.makedirs(folder, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=indent)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def as_records(spark, rows):
    """(batch, time, record) triples as exploded bronze rows."""
    from snapmart.schemas import record_schema

    def text(v):
        return v if v is None or isinstance(v, str) else repr(v)
    names = record_schema().fieldNames()
    data = [(b, t, tuple(text(r.get(n)) for n in names)) for b, t, r in rows]
    schema = f"ingestion_id string, batch_ingested_at string, coin struct<{','.join(n + ':string' for n in names)}>"
    return spark.createDataFrame(data, schema)


def silver_of(spark, rows):
    from snapmart.operators.records import flatten_and_cast
    return flatten_and_cast(as_records(spark, rows))
