import math
import random

import pytest
from pyspark.sql import functions as F

from snapmart.functions import (
    change_bucket, change_bucket_index, freshness_status, greatest_or_zero,
    hour_key, minutes_between_boundaries, percent_of, positive_ratio, round_half_away,
)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize("x,digits,expected", [
    (0.125, 2, 0.13), (-0.125, 2, -0.13), (2.5, 0, 3.0), (-2.5, 0, -3.0), (1.005, 2, 1.0),
    (1e300, 2, 1e300), (0.0, 4, 0.0), (12345.678949, 4, 12345.6789),
])
def test_round_half_away(spark, x, digits, expected):
    assert one(spark, round_half_away(F.lit(x), digits))[0] == expected


def test_round_keeps_null_and_nan(spark):
    row = one(spark, round_half_away(F.lit(None).cast("double"), 2), round_half_away(F.lit(float("nan")), 2))
    assert row[0] is None and math.isnan(row[1])


def test_guarded_division(spark):
    row = one(
        spark, percent_of(F.lit(1.0), F.lit(0.0)), percent_of(F.lit(1.0), F.lit(4.0)),
        positive_ratio(F.lit(1.0), F.lit(0.0)), positive_ratio(F.lit(1.0), F.lit(-2.0)),
        positive_ratio(F.lit(1.0), F.lit(2.0)), positive_ratio(F.lit(1.0), F.lit(None).cast("double")))
    assert list(row) == [None, 25.0, None, None, 0.5, None]


def test_greatest_or_zero(spark):
    null = F.lit(None).cast("double")
    row = one(spark, greatest_or_zero(null, null), greatest_or_zero(F.lit(2.0), null),
              greatest_or_zero(null, F.lit(-1.0)), greatest_or_zero(F.lit(1.0), F.lit(3.0)))
    assert list(row) == [0.0, 2.0, 0.0, 3.0]


def test_minutes_count_boundaries(spark):
    def minutes(a, b):
        return one(spark, minutes_between_boundaries(
            F.lit(a).cast("timestamp"), F.lit(b).cast("timestamp")))[0]
    assert minutes("2024-01-01 00:00:59", "2024-01-01 00:01:00") == 1
    assert minutes("2024-01-01 00:00:00", "2024-01-01 00:00:59") == 0
    assert minutes("2024-01-01 00:01:00", "2024-01-01 00:00:59") == -1
    assert minutes("1969-12-31 23:59:30", "1970-01-01 00:00:10") == 1


def test_hour_key_across_midnight(spark):
    row = one(spark, hour_key(F.lit("2024-06-01 00:59:59").cast("timestamp")),
              hour_key(F.lit("2023-12-31 23:00:00").cast("timestamp")))
    assert list(row) == [2024060100, 2023123123]


def test_change_buckets(spark):
    values = [10.0, 9.99, 5.0, 0.0, -0.01, -5.0, -5.01, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    x = F.col("x")
    rows = df.select(change_bucket(x), change_bucket_index(x), change_bucket(x, True)).collect()
    assert [r[1] for r in rows] == [0, 1, 1, 2, 3, 3, 4, 5]
    assert rows[-1][0] == "unknown" and rows[-1][2] == "💀 < -5%"


def test_freshness_status_at_the_limit(spark):
    row = one(spark, freshness_status(F.lit(90)), freshness_status(F.lit(91)))
    assert row[0].endswith("FRESH") and "STALE" in row[1]
