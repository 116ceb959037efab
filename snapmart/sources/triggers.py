"""Tables that a stream writes trigger by trigger.

Each trigger has a folder of its own by its number and replaces what an earlier try has
left there. A folder counts once its write has finished.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapmart.sources.files import child_names, exists

_PREFIX = "trigger="


def write_trigger(df: DataFrame, path: str, number: int, partition_by: Sequence[str] = ()) -> None:
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{_PREFIX}{number:09d}")


def finished_triggers(spark: SparkSession, path: str) -> list[str]:
    """The folders of finished triggers, in order."""
    folders = sorted(f"{path}/{n}" for n in child_names(spark, path) if n.startswith(_PREFIX))
    return [f for f in folders if exists(spark, f"{f}/_SUCCESS")]


def read_triggers(spark: SparkSession, path: str, schema: T.StructType, number: str | None = None) -> DataFrame:
    """The rows of all finished triggers; ``number`` names a column for the trigger's."""
    folders = finished_triggers(spark, path)
    whole = T.StructType([*schema, T.StructField("trigger", T.LongType())])
    if folders:
        rows = spark.read.schema(whole).option("basePath", path).parquet(*folders)
    else:
        rows = spark.createDataFrame([], whole)
    numbered = [F.col("trigger").alias(number)] if number else []
    return rows.select(*schema.fieldNames(), *numbered)
