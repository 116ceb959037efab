import pytest
from pyspark.sql import functions as F

from snapmart.suite import adapter, queries


@pytest.fixture
def tables(spark, scratch):
    """A folder with an ``events`` table of one file."""
    rows = spark.range(0, 40, numPartitions=1).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704100000) + F.col("id") * 3000).alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"),
        (F.col("id") + 0.5).alias("value"), F.lit('{"k": 20}').alias("props"))
    rows.write.parquet(f"{scratch}/events.parquet")
    return scratch


def test_checks_of_silver_do_not_build_gold(spark, tables, monkeypatch):
    def load_gold(*_):
        raise AssertionError("gold is not read here")
    monkeypatch.setattr(adapter, "load_gold", load_gold)
    assert queries.registry()["dq_summary_lines"](spark, tables).count() == 13


def test_gold_is_built_from_the_same_silver(spark, tables):
    path = adapter.silver_path(spark, tables)
    assert adapter.stored(spark, tables) == path.removesuffix("/silver")
    assert adapter.stored_gold(spark, tables).fact().count() == adapter.stored_silver(spark, tables).count() > 0
    assert adapter.stored(spark, tables) == path.removesuffix("/silver")


def test_events_are_widened_in_tasks_of_bounded_size(spark, tables, monkeypatch):
    whole = sorted(map(str, adapter.records(spark, tables).collect()))
    monkeypatch.setattr(adapter, "EVENTS_A_TASK", 10)
    spread = adapter.records(spark, tables)
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 20
    assert sorted(map(str, spread.collect())) == whole
