"""Surrogate keys for new natural keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Hex digits of the digest that choose a bucket: 16 ** 3 = 4096 buckets.
_DIGITS = 3


def key_bucket(key: str) -> Column:
    return F.substring(F.md5(F.col(key)), 1, _DIGITS)


def number_keys(df: DataFrame, key: str, out: str, after: Column) -> DataFrame:
    """Number the distinct values of ``key`` from ``after + 1`` on, without gaps.

    Keys are spread over a fixed number of digest buckets; each bucket is numbered
    alone and shifted by the sizes of the buckets before it. The numbers depend on
    the set of keys only.
    """
    keyed = df.withColumn("_bucket", key_bucket(key))
    # At most 4096 rows.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        keyed.groupBy("_bucket").agg(F.count("*").alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        keyed.join(F.broadcast(shifts), "_bucket")
        .withColumn(out, (after + F.col("_shift") + place).cast("bigint"))
        .drop("_bucket", "_shift")
    )
