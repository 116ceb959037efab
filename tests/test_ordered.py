"""The sliced operators against plain windows, with hot keys, ties and NULLs."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from snapmart.session import scratch_dir, scratch_scope
from snapmart.sources.files import child_names
from snapmart.operators.ordered import over_history, over_time, rank_descending, running_total, top

RNG = random.Random(11)


def history(spark, rows=900):
    # One key holds two thirds of the rows.
    data = [(0 if i % 3 else i % 7, RNG.randrange(200), i, float(RNG.randrange(1000))) for i in range(rows)]
    return spark.createDataFrame(data, "k int, t int, id int, v double").repartition(5)


def windows(w):
    return {
        "before": F.lag("v", 2).over(w), "after": F.lead("v").over(w),
        "mean": F.avg("v").over(w.rowsBetween(-4, 0)), "n": F.count("*").over(w.rowsBetween(-4, 1)),
    }


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("slices", [1, 3, 40, 700])
def test_sliced_history_equals_plain_window(spark, slices):
    df = history(spark)
    plain = over_history(df, ["k"], ["t", "id"], windows, back=4, ahead=1, sliced=False)
    sliced = over_history(df, ["k"], ["t", "id"], windows, back=4, ahead=1, slices=slices)
    assert sliced.columns == plain.columns
    assert bag(sliced) == bag(plain)


def test_slices_shorter_than_the_frame(spark):
    df = history(spark, 60)
    frame = lambda w: {"s": F.sum("v").over(w.rowsBetween(-23, 0))}
    plain = over_history(df, ["k"], ["t", "id"], frame, back=23, sliced=False)
    assert bag(over_history(df, ["k"], ["t", "id"], frame, back=23, slices=30)) == bag(plain)


def test_no_key_is_one_group(spark):
    df = history(spark, 200).withColumn("all", F.lit(1))
    lag = lambda w: {"p": F.lag("v").over(w)}
    plain = over_history(df, ["all"], ["t", "id"], lag, back=1, sliced=False)
    assert bag(over_history(df, ["all"], ["t", "id"], lag, back=1, slices=9)) == bag(plain)


def test_scratch_is_removed(spark):
    df = history(spark)
    before = set(child_names(spark, scratch_dir(spark)))
    with scratch_scope(spark):
        over_history(df, ["k"], ["t", "id"], windows, back=4, ahead=1, slices=9).collect()
        running_total(df, "id", [F.col("id")], "upto").collect()
        assert set(child_names(spark, scratch_dir(spark))) > before
    assert set(child_names(spark, scratch_dir(spark))) == before



def test_running_total_equals_window(spark):
    df = history(spark).select("id", F.when(F.col("id") % 5 > 0, F.col("v")).cast("decimal(12,2)").alias("v"))
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    plain = df.withColumn("s", F.sum("v").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    assert bag(running_total(df, "v", order, "s", slices=13)) == bag(plain)


def test_running_total_is_null_before_the_first_value(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5), (4, None), (5, 2)], "id int, v int")
    got = running_total(df, "v", [F.col("id")], "s", slices=4).orderBy("id").collect()
    assert [r.s for r in got] == [None, None, 5, 5, 7]


def test_rank_with_a_value_shared_by_most_rows(spark):
    data = [(i, None if i % 11 == 0 else float(i % 4 if i % 3 == 0 else 7)) for i in range(500)]
    df = spark.createDataFrame(data, "id int, v double")
    plain = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).cast("bigint"))
    assert bag(rank_descending(df, "v", "r", slices=6)) == bag(plain)


def test_top_is_a_partial_sort(spark):
    plan = top(history(spark), 5, F.col("v").desc())._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=60), st.integers(1, 12))
def test_random_histories(spark, rows, slices):
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "k int, t int, id int")
    frame = lambda w: {"p": F.lag("id").over(w), "n": F.lead("id").over(w)}
    plain = over_history(df, ["k"], ["t", "id"], frame, back=1, ahead=1, sliced=False)
    sliced = over_history(df, ["k"], ["t", "id"], frame, back=1, ahead=1, slices=slices)
    assert bag(sliced) == bag(plain)


def test_time_frames_equal_the_plain_window(spark):
    """One key has most rows; its frames reach over several slices."""
    rows = [("hot", i * 37 % 5000 if i % 3 else i % 50, i) for i in range(1500)]
    rows += [(f"k{i % 40}", i * 91 % 9000, i) for i in range(400)] + [(None, 5, 1), (None, 6, 2), ("hot", None, 9), ("hot", None, 10)]
    df = spark.createDataFrame(rows, "k string, t bigint, v bigint").withColumn("at", F.timestamp_seconds("t"))

    def columns(frame):
        return {"n": F.count("*").over(frame), "total": F.sum("v").over(frame), "least": F.min("v").over(frame)}

    for seconds in (1, 60, 4000):
        plain = sorted(map(str, over_time(df, ["k"], "at", seconds, columns, sliced=False).collect()))
        for slices in (1, 3, 16):
            cut = over_time(df, ["k"], "at", seconds, columns, slices=slices)
            assert cut.columns == df.columns + ["n", "total", "least"]
            assert sorted(map(str, cut.collect())) == plain
    assert over_time(df.limit(0), ["k"], "at", 60, columns).count() == 0
