import os
import re

import pytest
from pyspark.sql import functions as F

from samples import as_records, envelope, put, record
from snapmart.operators.records import flatten_and_cast
from snapmart.operators.summaries import envelope_preview, record_preview
from snapmart.sources.bronze import (
    build_envelopes, corrupt_envelopes, explode_records, read_bronze, read_envelopes, write_bronze,
)


def test_multi_line_documents_in_hive_folders(spark, scratch):
    put(f"{scratch}/year=2024/month=06/day=15/hour=10", "a.json", envelope(
        "b1", "2024-06-15T10:06:00+00:00", [record(), record(id="bb", name="Beta")],
        api_params={"vs_currency": "usd", "per_page": 2}))
    put(f"{scratch}/year=2024/month=06/day=15/hour=11", "b.json", envelope(
        "b2", "2024-06-15T11:06:00+00:00", [record()]))
    rows = read_bronze(spark, scratch)
    assert rows.columns == ["ingestion_id", "batch_ingested_at", "coin"]
    assert sorted((r.ingestion_id, r.coin.id) for r in rows.collect()) == [
        ("b1", "aa"), ("b1", "bb"), ("b2", "aa")]
    flat = flatten_and_cast(rows).filter("ingestion_id = 'b2'").first()
    assert (flat.current_price, flat.market_cap, flat.market_cap_rank) == (10.5, 1000.0, 1)
    assert (flat.year, flat.month, flat.day, flat.hour) == (2024, 6, 15, 11)
    assert flat.price_range_24h == 2.5 and flat.max_supply is None


def test_batches_without_records_disappear(spark, scratch):
    put(scratch, "a.json", envelope("b1", "2024-06-15T10:06:00Z", []))
    put(scratch, "b.json", envelope("b2", "2024-06-15T10:06:00Z", None))
    put(scratch, "c.json", envelope("b3", "2024-06-15T10:06:00Z", [record()]))
    assert [r.ingestion_id for r in read_bronze(spark, scratch).collect()] == ["b3"]


def test_truncated_file_is_quarantined(spark, scratch):
    put(scratch, "good.json", envelope("b1", "2024-06-15T10:06:00Z", [record()]))
    put(scratch, "bad.json", '{"ingestion_id": "b2", "data": [{"id": "x", "symb')
    envelopes = read_envelopes(spark, scratch)
    found = corrupt_envelopes(envelopes).collect()
    assert len(found) == 1 and '"symb' in found[0]._corrupt_record
    assert [r.ingestion_id for r in explode_records(envelopes).collect()] == ["b1"]


def test_malformed_leaf_spoils_only_itself(spark, scratch):
    put(scratch, "a.json", envelope("b1", "2024-06-15T10:06:00Z", [
        record(id="aa", current_price="n/a", market_cap_rank=3.0, ath_date="soon"),
        record(id="bb", current_price=1e-8, name=7, market_cap=[1, 2])]))
    envelopes = read_envelopes(spark, scratch)
    assert corrupt_envelopes(envelopes).collect() == []
    a, b = flatten_and_cast(explode_records(envelopes)).orderBy("coin_id").collect()
    assert a.current_price is None and a.market_cap == 1000.0 and a.ath_date is None
    assert a.market_cap_rank == 3 and a.last_updated is not None
    assert b.current_price == 1e-8 and b.market_cap is None and b.name == "7"


def batch(spark, rows):
    return as_records(spark, rows).withColumn("batch_ingested_at", F.to_timestamp("batch_ingested_at"))


@pytest.mark.parametrize("layout", ["documents", "lines"])
def test_round_trip(spark, scratch, layout):
    rows = [("b1", "2024-06-05T09:00:00Z", record(id=f"c{i}")) for i in range(5)]
    rows.append(("b2", "2024-06-05T10:00:00Z", record(id="c0", current_price=3.5)))
    write_bronze(build_envelopes(batch(spark, rows), "test"), scratch, layout)
    assert os.path.isdir(f"{scratch}/year=2024/month=06/day=05/hour=09")
    envelopes = read_envelopes(spark, scratch, layout)
    assert {(r.ingestion_id, r.record_count) for r in envelopes.collect()} == {("b1", "5"), ("b2", "1")}
    flat = flatten_and_cast(explode_records(envelopes))
    wanted = flatten_and_cast(batch(spark, rows).withColumn(
        "batch_ingested_at", F.date_format("batch_ingested_at", "yyyy-MM-dd'T'HH:mm:ssXXX")))
    assert sorted(map(str, flat.collect())) == sorted(map(str, wanted.collect()))


def test_documents_hold_one_envelope_per_file(spark, scratch):
    rows = [(f"b{i}", "2024-06-05T09:00:00Z", record()) for i in range(6)]
    write_bronze(build_envelopes(batch(spark, rows), "test"), scratch, "documents")
    files = [f for _, _, names in os.walk(scratch) for f in names if f.endswith(".json")]
    assert len(files) == 6


def test_large_batches_are_split_and_copies_kept(spark):
    rows = [("b1", "2024-06-05T09:00:00Z", record(id="hot")) for _ in range(40)]
    rows += [("b1", "2024-06-05T09:00:00Z", record(id=f"c{i}")) for i in range(40)]
    envelopes = build_envelopes(batch(spark, rows), "test", max_records=10)
    sizes = [r.record_count for r in envelopes.collect()]
    assert len(sizes) > 3 and sum(sizes) == 80 and max(sizes) < 40
    hot = envelopes.select(F.explode("data").alias("coin")).filter("coin.id = 'hot'")
    assert hot.count() == 40


def test_previews(spark, scratch):
    for i in range(7):
        put(scratch, f"{i}.json", envelope(f"b{i}", f"2024-06-15T10:0{i}:00Z", [record(), record(id="bb")]))
    envelopes = read_envelopes(spark, scratch)
    assert [r.ingestion_id for r in envelope_preview(envelopes).collect()] == ["b6", "b5", "b4", "b3", "b2"]
    assert record_preview(explode_records(envelopes)).count() == 10


def test_unknown_layout(spark, scratch):
    with pytest.raises(ValueError):
        read_envelopes(spark, scratch, "rows")


def _exchanges_of_records(frame):
    frame.collect()
    plan = frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    final = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    shown = set(re.findall(r"^\W*Exchange \((\d+)\)", final, re.M))
    nodes = re.findall(r"^\((\d+)\) Exchange\nInput \[\d+\]: \[(.*)\]", plan, re.M)
    return [columns for number, columns in nodes if number in shown and ("coin#" in columns or "buf#" in columns)]


def test_records_are_shuffled_once(spark, scratch):
    rows = [("b1", "2024-06-05T09:00:00Z", record(id=f"c{i}")) for i in range(40)]
    batch(spark, rows).write.parquet(f"{scratch}/records")
    envelopes = build_envelopes(spark.read.parquet(f"{scratch}/records"), "test", max_records=10)
    assert len(_exchanges_of_records(envelopes)) == 1


def test_copies_and_missing_keys_come_back(spark):
    rows = [(None, "2024-06-05T09:00:00Z", record(id="hot")) for _ in range(25)]
    rows += [("b1", None, record(id="c0")), ("b1", None, record(id="c0")), ("b1", "2024-06-05T09:00:00Z", record())]
    found = build_envelopes(batch(spark, rows), "test", max_records=10).select(
        "ingestion_id", "ingested_at", F.explode("data").alias("coin"))
    counts = found.groupBy("ingestion_id", F.col("ingested_at").isNull(), "coin.id").count().collect()
    assert sorted(map(str, map(tuple, counts))) == sorted(map(str, [
        (None, False, "hot", 25), ("b1", True, "c0", 2), ("b1", False, "aa", 1)]))


def test_compressed_lines_are_many_files(spark, scratch):
    rows = [("b1", "2024-06-05T09:00:00Z", record(id=f"c{i}")) for i in range(60)]
    envelopes = build_envelopes(batch(spark, rows), "test", max_records=5)
    write_bronze(envelopes, scratch, "lines", compression="gzip", envelopes_a_file=3)
    files = [f for _, _, names in os.walk(scratch) for f in names if f.endswith(".json.gz")]
    assert len(files) >= 3
    assert read_bronze(spark, scratch, "lines").count() == 60
