import pytest

from samples import as_records, envelope, put, record, silver_of
from snapmart.operators.dedup import drop_copies, keep_latest, keep_latest_by_aggregate
from snapmart.operators.records import keep_valid, rejected
from snapmart.operators.summaries import change_distribution, quality_summary, silver_preview
from snapmart.plans.silver import deduplicate, run_bronze_to_silver, to_silver
from snapmart.sources.bronze import read_bronze
from snapmart.sources.silver import append_silver, read_silver, write_silver

AT = "2024-06-15T10:06:00Z"


def test_flags_and_ratio(spark):
    rows = [("b", AT, record(id=i, **c)) for i, c in {
        "up": {"price_change_percentage_24h": 0.1}, "flat": {"price_change_percentage_24h": 0},
        "none": {"price_change_percentage_24h": None}, "zero": {"market_cap": 0},
        "negative": {"market_cap": -5}, "nocap": {"market_cap": None}}.items()]
    got = {r.coin_id: r for r in silver_of(spark, rows).collect()}
    assert got["up"].is_bullish_24h is True and got["flat"].is_bullish_24h is False
    assert got["none"].is_bullish_24h is None
    assert got["up"].volume_to_market_cap_ratio == 50.25 / 1000
    assert [got[k].volume_to_market_cap_ratio for k in ("zero", "negative", "nocap")] == [None] * 3


def test_sanity_filter(spark):
    changes = {
        "ok": {}, "noprice": {"current_price": None}, "zero": {"current_price": 0},
        "minus": {"current_price": -1}, "nocap": {"market_cap": None}, "nosymbol": {"symbol": None},
        "zerocap": {"market_cap": 0}, "nan": {"current_price": "NaN"}}
    rows = [("b", AT, record(id=i, **c)) for i, c in changes.items()] + [("b", AT, record(id=None))]
    flat = silver_of(spark, rows)
    assert sorted(r.coin_id for r in keep_valid(flat).collect()) == ["nan", "ok", "zerocap"]
    assert sorted(r.coin_id for r in keep_valid(flat, reject_nan=True).collect()) == ["ok", "zerocap"]
    assert keep_valid(flat).count() + rejected(flat).count() == flat.count()


@pytest.mark.parametrize("how", [keep_latest, keep_latest_by_aggregate])
def test_keep_latest(spark, how):
    rows = [
        ("b", AT, record(id="x", current_price=1, last_updated="2024-06-15T10:00:00Z")),
        ("b", AT, record(id="x", current_price=2, last_updated="2024-06-15T10:01:00Z")),
        ("b", AT, record(id="x", current_price=3, last_updated=None)),
        ("b2", AT, record(id="x", current_price=4, last_updated=None)),
        ("b", AT, record(id=None, current_price=5)), ("b", AT, record(id=None, current_price=6))]
    got = how(silver_of(spark, rows), ["ingestion_id", "coin_id"], ["last_updated"])
    found = {(r.ingestion_id, r.coin_id): r.current_price for r in got.collect()}
    assert found[("b", "x")] == 2 and found[("b2", "x")] == 4
    assert found[("b", None)] in (5, 6) and len(found) == 3
    assert got.columns == silver_of(spark, rows).columns


def test_ties_are_decided_the_same_way_every_time(spark):
    rows = [("b", AT, record(id="x", current_price=p)) for p in (1, 2, 3, 4, 5)]
    first = deduplicate(silver_of(spark, rows)).first().current_price
    for shift in range(1, 4):
        again = silver_of(spark, rows[shift:] + rows[:shift]).repartition(3)
        assert deduplicate(again).first().current_price == first
        assert keep_latest_by_aggregate(
            again, ["ingestion_id", "coin_id"], ["last_updated"]).first().current_price == first


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = keep_latest(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange", 1)[1]


def test_drop_copies(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1)], "a int, b int")
    assert drop_copies(df, ["a", "b"]).count() == 2


def test_pipeline_counts_and_files(spark, scratch):
    bronze, silver = f"{scratch}/bronze", f"{scratch}/silver"
    put(bronze, "a.json", envelope("b1", AT, [
        record(), record(), record(id="bb", current_price=0), record(id="cc")]))
    put(bronze, "b.json", envelope("b2", "2024-06-16T00:06:00Z", [record()]))
    counts = run_bronze_to_silver(spark, bronze, silver)
    assert counts == {"seen": 4, "kept": 3, "dropped": 1, "damaged": 0}
    stored = read_silver(spark, silver)
    assert stored.count() == 3 and len(stored.columns) == 34
    assert read_silver(spark, silver, since="2024-06-16").count() == 1
    assert read_silver(spark, silver, until="2024-06-16").count() == 2
    assert read_silver(spark, silver, "2024-06-15 10:06:00", "2024-06-15 10:06:00").count() == 0


def test_modes(spark, scratch):
    bronze, silver = f"{scratch}/bronze", f"{scratch}/silver"
    put(bronze, "a.json", envelope("b1", AT, [record(), record(id="bb")]))
    for mode in ("append", "append", "overwrite", "append", "refresh"):
        run_bronze_to_silver(spark, bronze, silver, mode=mode)
        assert read_silver(spark, silver).count() == 2
    other = f"{scratch}/other"
    put(other, "a.json", envelope("b2", "2024-06-16T00:06:00Z", [record()]))
    run_bronze_to_silver(spark, other, silver, mode="refresh")
    assert read_silver(spark, silver).count() == 3
    with pytest.raises(ValueError):
        run_bronze_to_silver(spark, bronze, silver, mode="merge")


def test_time_range_reads_only_its_folders(spark, scratch):
    rows = [(f"b{h}", f"2024-06-15T{h:02d}:00:00Z", record()) for h in range(6)]
    write_silver(to_silver(as_records(spark, rows)), scratch)
    part = read_silver(spark, scratch, "2024-06-15 02:00:00", "2024-06-15 04:00:00")
    assert sorted(r.hour for r in part.collect()) == [2, 3]
    scan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "hour" in scan.split("PartitionFilters: [")[1]


def test_append_adds_only_what_is_not_stored(spark, scratch):
    write_silver(to_silver(as_records(spark, [("b1", AT, record())])), scratch)
    rows = [("b1", AT, record()), ("b1", AT, record(id="bb")), ("b2", "2024-06-15T12:00:00Z", record()),
            ("b1", "2024-06-15T13:00:00Z", record())]  # the last is the first one again
    append_silver(to_silver(as_records(spark, rows)), scratch)
    assert read_silver(spark, scratch).count() == 3


def test_rows_without_batch_time_are_appended_once(spark, scratch):
    rows = to_silver(as_records(spark, [("b1", AT, record()), ("b2", "soon", record())]))
    append_silver(rows, scratch)
    append_silver(rows, scratch)
    assert read_silver(spark, scratch).count() == 2


def test_range_of_bronze(spark, scratch):
    bronze, silver = f"{scratch}/bronze", f"{scratch}/silver"
    for h in (9, 10, 11):
        put(f"{bronze}/year=2024/month=06/day=15/hour={h:02d}", "a.json",
            envelope(f"b{h}", f"2024-06-15T{h:02d}:06:00Z", [record()]))
    put(f"{bronze}/year=2024/month=06/day=15/hour=10", "cut.json", '{"ingestion_id": "b10", "data": [{"id"')
    rows = read_bronze(spark, bronze, since="2024-06-15 10:00:00", until="2024-06-15 11:00:00")
    assert [r.ingestion_id for r in rows.collect()] == ["b10"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hour" in plan.split("PartitionFilters: [")[1].split("]")[0]
    counts = run_bronze_to_silver(spark, bronze, silver, mode="refresh", since="2024-06-15 10:00:00")
    assert (counts["kept"], counts["damaged"]) == (2, 1)
    with pytest.raises(ValueError):
        run_bronze_to_silver(spark, bronze, silver, since="2024-06-15")


def test_summaries(spark):
    flat = silver_of(spark, [
        ("b", AT, record(id=None, price_change_percentage_24h=None)),
        ("b", AT, record(id="x", current_price=None, price_change_percentage_24h=12)),
        ("b", AT, record(id="y", price_change_percentage_24h=-7, market_cap_rank=2))])
    row = quality_summary(flat).first()
    assert (row.total_records, row.non_null_coins, row.null_coinid_count, row.null_price_count) == (3, 2, 1, 1)
    assert row.bullish_coins == 1 and row.avg_24h_change_pct == 2.5
    buckets = {r.price_bucket: r.coin_count for r in change_distribution(flat).collect()}
    assert buckets == {"🚀 > +10%": 1, "💀 < -5%": 1, "unknown": 1}
    assert silver_preview(flat, 1).columns[-1] == "batch_ingested_at"
