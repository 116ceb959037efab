"""Distinct counts that can be merged: one sketch per hour, united for any range of time.

An exact distinct count has to see all entities of a range again. A sketch has a fixed
size (some kilobytes), is worked out once per hour, and the union of sketches is the
sketch of the union; it costs a small relative error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from snapmart.schemas import FACT_PARTITION

# A sketch has 2 ** PRECISION registers.
PRECISION = 14
_STORED = T.StructType([
    T.StructField("date_sk", T.LongType()), T.StructField("rows", T.LongType()),
    T.StructField("entities", T.BinaryType()), T.StructField(FACT_PARTITION, T.DateType())])


def relative_error(precision: int = PRECISION) -> float:
    """Relative standard deviation of an estimate."""
    return 1.04 / (1 << precision) ** 0.5


def hourly_sketches(fact: DataFrame, entity: str = "coin_sk", precision: int = PRECISION) -> DataFrame:
    """(date_sk, rows, entities, snapshot_date) per day and hour; ``entities`` is the sketch."""
    return fact.groupBy(FACT_PARTITION, F.col("date_sk").cast("bigint").alias("date_sk")).agg(
        F.count("*").alias("rows"), F.hll_sketch_agg(entity, precision).alias("entities"),
    ).select(*_STORED.fieldNames())


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Write the sketches, replacing the days they are of and no others."""
    sketches.hint("rebalance", FACT_PARTITION).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(FACT_PARTITION).parquet(path)


def read_sketches(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """Stored sketches, of the days in ``[since, until)`` only if given; other folders are
    not opened."""
    df = spark.read.schema(_STORED).parquet(path)
    if since is not None:
        df = df.filter(F.col(FACT_PARTITION) >= F.lit(since).cast("date"))
    if until is not None:
        df = df.filter(F.col(FACT_PARTITION) < F.lit(until).cast("date"))
    return df


def estimate() -> Column:
    """Aggregate: estimated distinct entities of all rows together."""
    return F.hll_sketch_estimate(F.hll_union_agg("entities"))


def distinct_entities(sketches: DataFrame, *by: str) -> DataFrame:
    """(by..., rows, entities): estimated distinct entities per group, from sketches alone."""
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), estimate().alias("entities"))


def within_bounds(exact: Column, estimated: Column, precision: int = PRECISION, deviations: float = 4.0) -> Column:
    """Whether an estimate is as near to the exact count as its error allows."""
    return F.abs(exact - estimated) <= F.greatest(F.lit(1.0), exact * (deviations * relative_error(precision)))
