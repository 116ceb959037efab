import os

import pytest
from pyspark.sql import functions as F

from samples import record, silver_of
from snapmart.operators.contracts import conform, contract_violations
from snapmart.operators.keys import number_keys
from snapmart.operators.upsert import insert_if_absent
from snapmart.plans import gold
from snapmart.plans.silver import to_silver
from snapmart.schemas import CONTRACTS, DIM_COIN_CONTRACT, FACT_CONTRACT, STAGING_COLUMNS
from snapmart.sources.gold import GoldStore
from snapmart.sources.silver import write_silver
from snapmart.sources.tables import write_table


def at(text):
    return F.lit(text).cast("timestamp")


T1, T2 = "2024-06-15T10:06:00Z", "2024-06-15T11:06:00Z"


def first_load(spark):
    return silver_of(spark, [
        ("b1", T1, record(id="aa", ath=20, atl=1)), ("b1", T1, record(id="bb", ath=None))])


def second_load(spark):
    return silver_of(spark, [
        ("b1", T1, record(id="aa", ath=20, atl=1)),
        ("b2", T2, record(id="aa", symbol="A2", name="New", ath=15, atl=0.5, circulating_supply=7, total_supply=9)),
        ("b2", T2, record(id="bb", ath=None)), ("b2", T2, record(id="cc", ath=3))])


def loaded(spark, root, rows, when):
    outcome = gold.load_gold(rows, root, at(when))
    return outcome, GoldStore(spark, root)


def test_upsert_keeps_updates_and_inserts(spark, scratch):
    loaded(spark, scratch, first_load(spark), "2024-07-01")
    keys = {r.coin_id: r.coin_sk for r in GoldStore(spark, scratch).dim_coin().collect()}
    assert sorted(keys.values()) == [1, 2]
    _, store = loaded(spark, scratch, second_load(spark), "2024-07-02")
    dim = {r.coin_id: r for r in store.dim_coin().collect()}
    a, b, c = dim["aa"], dim["bb"], dim["cc"]
    assert (a.coin_sk, a.symbol, a.name, a.circulating_supply) == (keys["aa"], "A2", "New", 7.0)
    assert (a.ath, a.atl, a.total_supply) == (20.0, 1.0, 110.0)
    assert str(a.first_seen_at) < str(a.last_updated_at) and a.is_active is True
    assert b.ath == 0.0 and b.coin_sk == keys["bb"]
    assert c.coin_sk == 3 and c.ath == 3.0 and c.first_seen_at == c.last_updated_at


def test_loading_again_changes_nothing(spark, scratch):
    loaded(spark, scratch, second_load(spark), "2024-07-01")
    before = {n: sorted(map(str, t.collect())) for n, t in GoldStore(spark, scratch).tables().items()}
    _, store = loaded(spark, scratch, second_load(spark), "2024-07-01")
    after = {n: sorted(map(str, t.collect())) for n, t in store.tables().items()}
    # A coin without a recorded high gets zero on its first update.
    before["dim_coin"] = [r.replace("name='Alpha', ath=None", "name='Alpha', ath=0.0") for r in before["dim_coin"]]
    assert before == after and len(after["fact_market_snapshot"]) == 4


def test_fact_columns_and_folders(spark, scratch):
    _, store = loaded(spark, scratch, second_load(spark), "2024-07-01")
    fact = store.fact()
    assert fact.columns == FACT_CONTRACT.schema.fieldNames() + ["snapshot_date"]
    row = fact.filter("snapshot_id = 'aa_b2'").first()
    assert row.date_sk == 2024061511 and row.price_range_24h == 2.5
    assert "snapshot_date=2024-06-15" in os.listdir(store.path("fact_market_snapshot"))
    assert {r.date_sk for r in store.dim_date().collect()} == {2024061510, 2024061511}


def test_interrupted_load_is_completed(spark, scratch):
    rows = gold.stage(second_load(spark))
    store = GoldStore(spark, scratch)
    latest = gold.latest_entities(rows, at("2024-07-01"))
    store.replace_dim_coin(gold.upsert_entities(store.dim_coin(), latest, at("2024-07-01")))
    keys = {r.coin_id: r.coin_sk for r in store.dim_coin().collect()}
    assert store.fact().count() == 0
    _, store = loaded(spark, scratch, second_load(spark), "2024-07-01")
    assert {r.coin_id: r.coin_sk for r in store.dim_coin().collect()} == keys
    assert store.fact().count() == 4 and store.dim_date().count() == 2


def test_unfinished_version_is_ignored(spark, scratch):
    _, store = loaded(spark, scratch, first_load(spark), "2024-07-01")
    os.makedirs(f"{store.path('dim_coin')}/v=2")
    assert store.dim_coin().count() == 2
    loaded(spark, scratch, second_load(spark), "2024-07-02")
    assert store.dim_coin().count() == 3


def test_second_load_adds_no_date_file(spark, scratch):
    _, store = loaded(spark, scratch, first_load(spark), "2024-07-01")
    before = sorted(os.listdir(store.path("dim_date")))
    loaded(spark, scratch, first_load(spark), "2024-07-02")
    assert sorted(os.listdir(store.path("dim_date"))) == before


def test_staging_duplicates_and_null_keys(spark, scratch):
    rows = silver_of(spark, [
        ("b1", T1, record(id="aa", current_price=1, last_updated="2024-06-15T10:00:00Z")),
        ("b1", T1, record(id="aa", current_price=2, last_updated="2024-06-15T10:01:00Z")),
        ("b1", T1, record(id=None)), (None, T1, record(id="aa")), ("b1", "never", record(id="zz"))])
    outcome, store = loaded(spark, scratch, rows, "2024-07-01")
    assert outcome == {"staged": 5, "quarantined": 3}
    fact = store.fact().collect()
    assert [(r.snapshot_id, r.current_price) for r in fact] == [("aa_b1", 2.0)]


def test_empty_staging_stops_the_load(spark, scratch):
    outcome, store = loaded(spark, scratch, first_load(spark).limit(0), "2024-07-01")
    assert outcome["staged"] == 0 and store.fact().count() == 0 and store.dim_coin().count() == 0


def test_pipeline_counts(spark, scratch):
    write_silver(to_silver_rows(spark), f"{scratch}/silver")
    counts = gold.run_silver_to_gold(spark, f"{scratch}/silver", f"{scratch}/gold", at("2024-07-01"))
    assert {r.table_name: r.row_count for r in counts.collect()} == {
        "fact_market_snapshot": 2, "dim_coin": 2, "dim_date": 1}
    assert gold.run_silver_to_gold(
        spark, f"{scratch}/silver", f"{scratch}/other", since="2030-01-01") is None


def to_silver_rows(spark):
    from samples import as_records
    return to_silver(as_records(spark, [("b1", T1, record(id="aa")), ("b1", T1, record(id="bb"))]))


def test_staging_projection(spark):
    rows = first_load(spark)
    assert gold.stage(rows).columns == list(STAGING_COLUMNS)
    assert gold.stage(rows, upper_case=True).columns == [c.upper() for c in STAGING_COLUMNS]
    text = rows.select("coin_id", F.lit("bad time").alias("last_updated"), F.lit("2024-01-01T00:00:00Z").alias("ath_date"))
    row = gold.stage(text).first()
    assert row.last_updated is None and row.ath_date is not None and len(row) == 3


def test_surrogate_keys_depend_on_the_key_set_only(spark):
    names = spark.createDataFrame([(f"n{i}",) for i in range(500)], "name string")
    first = {r.name: r.sk for r in number_keys(names, "name", "sk", F.lit(10)).collect()}
    again = {r.name: r.sk for r in number_keys(names.repartition(7), "name", "sk", F.lit(10)).collect()}
    assert first == again and sorted(first.values()) == list(range(11, 511))


def test_insert_if_absent_keeps_null_keys(spark):
    source = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    target = spark.createDataFrame([("a",), (None,)], "k string")
    assert sorted(str(r.k) for r in insert_if_absent(target, source, ["k"]).collect()) == ["None", "b"]


def test_contract_violations(spark, scratch):
    _, store = loaded(spark, scratch, second_load(spark), "2024-07-01")
    tables = store.tables()
    for name, contract in CONTRACTS.items():
        assert contract_violations(tables[name], contract, tables).filter("violations > 0").count() == 0
    broken = tables["fact_market_snapshot"].unionByName(
        tables["fact_market_snapshot"].withColumn("coin_sk", F.lit(99).cast("bigint"))
        .withColumn("current_price", F.lit(None).cast("double")))
    found = {(r.constraint_type, r.column_names): r.violations
             for r in contract_violations(broken, FACT_CONTRACT, tables).collect()}
    assert found[("PRIMARY_KEY", "snapshot_id")] == 4 and found[("FOREIGN_KEY", "coin_sk")] == 4
    assert found[("NOT_NULL", "current_price")] == 4 and found[("FOREIGN_KEY", "date_sk")] == 0


def test_conform_fills_defaults(spark):
    row = conform(spark.createDataFrame([("x",)], "coin_id string"), DIM_COIN_CONTRACT,
                  F.lit("2024-01-01").cast("timestamp")).first()
    assert row.coin_id == "x" and row.is_active is True and row.ath is None and len(row) == 14


def test_generic_sink(spark, scratch):
    write_table(spark.range(3).toDF("id"), "csv", "overwrite", path=f"{scratch}/out", header=True)
    assert spark.read.csv(f"{scratch}/out", header=True).count() == 3


def test_snapshot_redelivered_across_midnight_is_one_fact(spark, scratch):
    for at_time, when in (("2024-01-01T23:59:00Z", "2024-07-01"), ("2024-01-02T00:01:00Z", "2024-07-02")):
        _, store = loaded(spark, scratch, silver_of(spark, [("b1", at_time, record(id="aa"))]), when)
    row, = store.fact().collect()
    assert row.snapshot_id == "aa_b1" and str(row.snapshot_date) == "2024-01-01"
    tables = store.tables()
    assert contract_violations(store.fact(), FACT_CONTRACT, tables).filter("violations > 0").count() == 0


def test_rows_that_would_break_a_contract_are_quarantined(spark, scratch):
    rows = silver_of(spark, [
        ("b1", "2024-06-15T10:00:00Z", record()), ("b1", "2024-06-15T10:00:00Z", record(id="bb", name=None)),
        ("b1", "2024-06-15T10:00:00Z", record(id="cc", current_price=None, symbol=None))])
    outcome, store = loaded(spark, scratch, rows, "2024-07-01")
    assert outcome == {"staged": 3, "quarantined": 2}
    assert store.fact().count() == 1 and store.dim_coin().count() == 1
    reasons = {r.missing_column: r.rows for r in gold.quarantine_reasons(gold.stage(rows)).collect()}
    assert reasons == {"coin_id": 0, "ingestion_id": 0, "batch_ingested_at": 0, "symbol": 1, "name": 1,
                       "current_price": 1}


def test_newest_fact_opens_one_folder(spark, scratch):
    days = [f"2024-06-{d:02d}T10:00:00Z" for d in range(10, 15)]
    _, store = loaded(spark, scratch, silver_of(spark, [(f"b{t}", t, record()) for t in days]), "2024-07-01")
    newest = store.newest_fact()
    assert [str(r.snapshot_date) for r in newest.collect()] == ["2024-06-14"]
    assert len(newest.inputFiles()) >= 1 and len(newest.select("_metadata.file_path").distinct().collect()) == 1
    assert "2024-06-14" in newest._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_old_versions_go_by_age(spark, scratch):
    for day in ("2024-07-01", "2024-07-02", "2024-07-03"):
        _, store = loaded(spark, scratch, second_load(spark), day)
    assert store.drop_old_versions() == 0 and store.drop_old_versions(hours=-1) == 2
    assert store.dim_coin().count() == 3


def test_another_time_zone_is_refused(spark, scratch):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError):
            loaded(spark, scratch, second_load(spark), "2024-07-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

