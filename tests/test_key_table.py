import os

import pytest
from pyspark.sql import functions as F

from samples import record, silver_of
from snapmart.plans import gold
from snapmart.sources.gold import GoldStore, entity_buckets
from snapmart.sources.key_table import KeyTable
from snapmart.sources.silver import append_silver, read_silver, silver_keys, write_silver


def at(text):
    return F.lit(text).cast("timestamp")


def day(d):
    return f"2024-06-{d:02d}T10:00:00Z"


def table(spark, path, buckets=16):
    return KeyTable(spark, path, ["a", "b"], lambda: spark.read.parquet(path), buckets)


def rows(spark, values):
    return spark.createDataFrame(values, "a string, b string")


def files_read(df):
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_only_touched_buckets_are_read(spark, scratch):
    stored = [(f"a{i}", f"b{i % 7}") for i in range(400)] + [(None, "b"), ("a", None)]
    rows(spark, stored).write.parquet(f"{scratch}/t")
    keys = table(spark, f"{scratch}/t")
    probe = rows(spark, [("a3", "b3"), ("new", "b"), (None, "b"), ("a", None), (None, None)])
    assert {(r.a, r.b) for r in keys.absent(probe).collect()} == {("new", "b"), (None, None)}
    some = keys.of_buckets(rows(spark, [("a3", "b3")]))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "key_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    folders = {path.split("key_bucket=")[1].split("/")[0] for path in files_read(some)}
    assert len(folders) == 1 and 0 < some.count() < 100


def test_an_addition_that_stopped_half_way_is_found(spark, scratch):
    path = f"{scratch}/t"
    rows(spark, [("a", "1")]).write.parquet(path)
    keys, more = table(spark, path), rows(spark, [("b", "1"), ("c", "1")])
    with pytest.raises(RuntimeError):
        with keys.adding(more):
            more.write.mode("append").parquet(path)
            raise RuntimeError("lost")
    assert os.path.exists(keys.marker)
    assert keys.absent(rows(spark, [("b", "1"), ("d", "1")])).collect() == [("d", "1")]
    assert not os.path.exists(keys.marker) and spark.read.parquet(path).count() == 3


def test_many_additions_and_compaction(spark, scratch):
    path = f"{scratch}/t"
    rows(spark, [("x", "0")]).write.parquet(path)
    keys = table(spark, path, 4)
    for i in range(4):
        more = rows(spark, [(f"n{i}", str(j)) for j in range(20)])
        assert keys.absent(more).count() == 20
        with keys.adding(more):
            more.write.mode("append").parquet(path)
        assert keys.absent(more).count() == 0
    before = sum(len(f) for *_, f in os.walk(keys.path))
    keys.compact()
    assert sum(len(f) for *_, f in os.walk(keys.path)) < before
    assert keys.absent(spark.read.parquet(path)).count() == 0


def test_silver_key_is_found_under_another_day_and_after_a_rewrite(spark, scratch):
    first = silver_of(spark, [("b1", day(1), record()), ("b1", None, record(id="bb"))])
    append_silver(first, scratch)
    append_silver(silver_of(spark, [("b1", day(9), record()), ("b1", day(9), record(id="bb")), ("b2", day(9), record())]), scratch)
    assert read_silver(spark, scratch).count() == 3
    # Another way of writing makes the index void.
    write_silver(silver_of(spark, [("b7", day(2), record())]), scratch)
    assert not os.path.exists(silver_keys(spark, scratch).root)
    append_silver(silver_of(spark, [("b7", day(3), record()), ("b8", day(3), record())]), scratch)
    assert sorted(r.ingestion_id for r in read_silver(spark, scratch).collect()) == ["b7", "b8"]


def test_load_of_one_entity_rewrites_one_bucket(spark, scratch):
    many = silver_of(spark, [("b1", day(1), record(id=f"c{i}")) for i in range(60)])
    gold.load_gold(many, scratch, at("2024-07-01"))
    store = GoldStore(spark, scratch)
    assert store.last_coin_sk() == 60
    before = files_read(store.dim_coin())
    one = silver_of(spark, [("b2", day(2), record(id="c7", name="New"))])
    gold.load_gold(one, scratch, at("2024-07-02"))
    after = files_read(store.dim_coin())
    assert len(before - after) == 1 and len(after - before) == 1
    bucket, = entity_buckets(one)
    written = os.listdir(f"{scratch}/dim_coin/load=2")
    assert [n for n in written if "=" in n] == [f"entity_bucket={bucket}"]
    dim = {r.coin_id: r for r in store.dim_coin().collect()}
    assert len(dim) == 60 and dim["c7"].name == "New" and dim["c8"].name == "Alpha"
    gold.load_gold(silver_of(spark, [("b3", day(3), record(id="zz"))]), scratch, at("2024-07-03"))
    assert store.last_coin_sk() == 61 and store.dim_coin().filter("coin_id = 'zz'").first().coin_sk == 61
    # Buckets that only replaced versions name go with them, the others stay.
    assert store.drop_old_versions(hours=-1) == 2 and store.dim_coin().count() == 61
    assert not os.path.exists(f"{scratch}/dim_coin/load=1/entity_bucket={bucket}")


def test_fact_load_reads_keys_of_touched_buckets(spark, scratch):
    gold.load_gold(silver_of(spark, [("b1", day(1), record(id=f"c{i}")) for i in range(80)]), scratch, at("2024-07-01"))
    store = GoldStore(spark, scratch)
    stored = store.fact_keys().of_buckets(store.fact().filter("snapshot_id = 'c5_b1'").select("snapshot_id"))
    assert 1 <= stored.count() < 10 and len(files_read(stored)) == 1
    # The same snapshots on another day, and one new.
    again = silver_of(spark, [("b1", day(4), record(id=f"c{i}")) for i in range(81)])
    gold.load_gold(again, scratch, at("2024-07-02"))
    assert store.fact().count() == 81 and store.fact().filter("snapshot_date = '2024-06-04'").count() == 1
