from pyspark.sql import functions as F

from samples import as_records, envelope, put, record
from snapmart.operators.records import flatten_and_cast, keep_valid
from snapmart.plans.gold import load_gold
from snapmart.plans.silver import deduplicate
from snapmart.sources.bronze import read_bronze
from snapmart.sources.gold import GoldStore
from snapmart.sources.silver import append_silver, read_silver
from snapmart.sources.triggers import finished_triggers
from snapmart.streaming import ingest

T1, T2 = "2024-06-15T10:06:00Z", "2024-06-15T11:06:00Z"


def land(folder, name, batch, at, *records):
    put(folder, name, envelope(batch, at, list(records)))


def drain(query):
    query.awaitTermination()


def by_key(df):
    return {(r.ingestion_id, r.coin_id): r.current_price for r in df.collect()}


def test_keep_latest_equals_batch_however_rows_arrive(spark, scratch):
    bronze, silver, progress = f"{scratch}/bronze", f"{scratch}/silver", f"{scratch}/progress"

    def run():
        drain(ingest.start_keep_latest(
            ingest.stream_rows(spark, bronze, max_files_per_trigger=1), silver, progress, availableNow=True))

    land(bronze, "1.json", "b1", T1, record(current_price=2, last_updated="2024-06-15T10:02:00Z"),
         record(id="bb"), record(id="cc", current_price=0))
    land(bronze, "2.json", "b2", T2, record(current_price=5))
    run()
    assert by_key(ingest.read_latest(spark, silver)) == {("b1", "aa"): 2.0, ("b1", "bb"): 10.5, ("b2", "aa"): 5.0}
    land(bronze, "3.json", "b1", T1, record(current_price=1, last_updated="2024-06-15T10:01:00Z"))
    land(bronze, "4.json", "b1", T1, record(current_price=3, last_updated="2024-06-15T10:03:00Z"))
    run()
    batch = deduplicate(keep_valid(flatten_and_cast(read_bronze(spark, bronze))))
    assert by_key(ingest.read_latest(spark, silver)) == by_key(batch)
    assert by_key(batch)[("b1", "aa")] == 3.0 and batch.count() == ingest.read_latest(spark, silver).count()
    run()
    assert ingest.read_latest(spark, silver).count() == batch.count()
    for _ in range(2):
        ingest.compact(spark, silver, f"{scratch}/compact")
        assert by_key(read_silver(spark, f"{scratch}/compact")) == by_key(batch)
        assert read_silver(spark, f"{scratch}/compact").count() == batch.count()


def test_first_seen(spark, scratch):
    bronze, silver = f"{scratch}/bronze", f"{scratch}/silver"
    land(bronze, "1.json", "b1", T1, record(), record(), record(id="bb"))
    rows = ingest.stream_rows(spark, bronze)
    drain(ingest.start_first_seen(rows, silver, f"{scratch}/progress", availableNow=True))
    land(bronze, "2.json", "b1", T1, record(current_price=9))
    land(bronze, "3.json", "b2", T2, record())
    drain(ingest.start_first_seen(rows, silver, f"{scratch}/progress", availableNow=True))
    assert by_key(read_silver(spark, silver)) == {("b1", "aa"): 10.5, ("b1", "bb"): 10.5, ("b2", "aa"): 10.5}
    assert read_silver(spark, silver).count() == 3
    # Batch jobs may append next to the stream, and a snapshot may come hours late.
    append_silver(deduplicate(flatten_and_cast(as_records(spark, [("b9", T2, record())]))), silver)
    land(bronze, "4.json", "b0", "2024-06-15T03:06:00Z", record())
    land(bronze, "5.json", "b5", "soon", record())
    land(bronze, "6.json", "b6", "soon", record())
    drain(ingest.start_first_seen(rows, silver, f"{scratch}/progress", availableNow=True))
    assert sorted(r.ingestion_id for r in read_silver(spark, silver).collect()) == [
        "b0", "b1", "b1", "b2", "b5", "b6", "b9"]


def test_gold_stream_while_silver_is_written(spark, scratch):
    """The gold stream has listed its files when further versions of the same hour arrive."""
    bronze, silver, root = f"{scratch}/bronze", f"{scratch}/silver", f"{scratch}/gold"
    as_of = F.lit("2024-07-01").cast("timestamp")

    def keep():
        drain(ingest.start_keep_latest(
            ingest.stream_rows(spark, bronze), silver, f"{scratch}/p1", availableNow=True))

    def load(batch, number):
        land(bronze, f"more{number}.json", "b1", T1, record(current_price=7), record(id=f"x{number}"))
        keep()
        load_gold(batch, root, as_of)

    land(bronze, "1.json", "b1", T1, record())
    keep()
    for _ in range(2):
        drain(ingest.stream_silver(spark, silver).writeStream.foreachBatch(load).option(
            "checkpointLocation", f"{scratch}/p2").trigger(availableNow=True).start())
    assert {"aa_b1", "x0_b1"} <= {r.snapshot_id for r in GoldStore(spark, root).fact().collect()}


def test_gold_refresh(spark, scratch):
    bronze, silver, gold = f"{scratch}/bronze", f"{scratch}/silver", f"{scratch}/gold"
    as_of = F.lit("2024-07-01").cast("timestamp")

    def run():
        drain(ingest.start_keep_latest(
            ingest.stream_rows(spark, bronze), silver, f"{scratch}/p1", availableNow=True))
        drain(ingest.start_gold_refresh(
            ingest.stream_silver(spark, silver), gold, f"{scratch}/p2", as_of, availableNow=True))

    land(bronze, "1.json", "b1", T1, record(), record(id="bb"))
    run()
    land(bronze, "2.json", "b2", T2, record(), record(id="cc"))
    run()
    store = GoldStore(spark, gold)
    assert sorted(r.snapshot_id for r in store.fact().collect()) == ["aa_b1", "aa_b2", "bb_b1", "cc_b2"]
    assert sorted(r.coin_sk for r in store.dim_coin().collect()) == [1, 2, 3]
    assert store.dim_date().count() == 2


def day(d, hour=10):
    return f"2024-06-{d:02d}T{hour:02d}:00:00Z"


def test_first_seen_within_forgets_and_drops(spark, scratch):
    """Every run is a restart from the checkpoint; state and watermark survive it."""
    bronze, silver = f"{scratch}/bronze", f"{scratch}/silver"

    def run(name, *batches):
        for i, (batch, at, *records) in enumerate(batches):
            land(bronze, f"{name}{i}.json", batch, at, *records)
        query = ingest.start_first_seen_within(
            ingest.stream_rows(spark, bronze), silver, f"{scratch}/progress", "2 days", availableNow=True)
        drain(query)
        kept = sum(s["numRowsTotal"] for p in query.recentProgress[-1:] for s in p["stateOperators"])
        return ingest.dropped_as_late(query), kept

    late, _ = run("a", ("b1", day(1), record(), record(), record(id="bb")), ("b0", None, record(id="undated")))
    assert late == 0 and by_key(read_silver(spark, silver)) == {("b1", "aa"): 10.5, ("b1", "bb"): 10.5}
    # A repeat in time changes nothing, a late row in time is taken.
    late, _ = run("b", ("b1", day(1), record(current_price=9)), ("b5", day(5), record()), ("b1", day(1), record(id="cc")))
    assert late == 0 and sorted(by_key(read_silver(spark, silver))) == [
        ("b1", "aa"), ("b1", "bb"), ("b1", "cc"), ("b5", "aa")]
    # The watermark stands at the third: what is older is dropped, repeated or new.
    late, kept = run("c", ("b1", day(1), record(), record(id="dd")), ("b4", day(4), record()), ("b9", day(9), record()))
    assert late == 2 and read_silver(spark, silver).count() == 6
    assert ("b4", "aa") in by_key(read_silver(spark, silver))
    # Only snapshots of the last while are held.
    assert kept < 6
    assert read_silver(spark, silver).groupBy("ingestion_id", "coin_id").count().filter("count > 1").count() == 0


def test_first_seen_within_gathers_rows_by_hour(spark, scratch):
    """A trigger writes a few files per hour, however many tasks its state is dealt to."""
    bronze, silver = f"{scratch}/bronze", f"{scratch}/silver"
    land(bronze, "a.json", "b1", day(1), *[record(id=f"c{i}") for i in range(200)])
    rows = ingest.stream_rows(spark, bronze)
    drain(ingest.start_first_seen_within(rows, silver, f"{scratch}/progress", "2 days", availableNow=True))
    stored = read_silver(spark, silver)
    assert stored.count() == 200
    assert len(stored.inputFiles()) <= ingest.TASKS_AN_HOUR < int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_landing_keeps_rows_and_damage_once(spark, scratch):
    bronze, rows, damaged, progress = [f"{scratch}/{x}" for x in ("bronze", "rows", "damaged", "progress")]

    def start():
        return ingest.start_landing(spark, bronze, rows, damaged, progress, availableNow=True)

    land(bronze, "1.json", "b1", T1, record(), record(current_price=0, id="bad"))
    put(bronze, "2.json", '{"ingestion_id": "b2", "data": [{"id"')
    drain(start())
    assert by_key(ingest.read_landed(spark, rows)) == {("b1", "aa"): 10.5}
    assert ingest.read_damaged(spark, damaged).count() == 1
    # The second sink fails after the first was written; the trigger is run again.
    land(bronze, "3.json", "b3", T2, record(), record(id="bb"))
    put(bronze, "4.json", "no envelope")
    keep, ingest.corrupt_envelopes = ingest.corrupt_envelopes, None
    try:
        query = start()
        try:
            query.awaitTermination()
        except Exception:
            pass
        assert query.exception() is not None and len(finished_triggers(spark, rows)) == 2
    finally:
        ingest.corrupt_envelopes = keep
    for _ in range(2):
        drain(start())
        landed = ingest.read_landed(spark, rows)
        assert by_key(landed) == {("b1", "aa"): 10.5, ("b3", "aa"): 10.5, ("b3", "bb"): 10.5}
        assert landed.count() == 3 and ingest.read_damaged(spark, damaged).count() == 2


def test_nothing_landed_yet(spark, scratch):
    assert ingest.read_landed(spark, f"{scratch}/none").count() == 0
    assert ingest.read_damaged(spark, f"{scratch}/none").count() == 0
