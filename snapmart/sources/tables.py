"""Generic table sink and row-count check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def write_table(df: DataFrame, format: str = "parquet", mode: str = "overwrite", **options) -> None:
    """Hand ``df`` to any Spark data source; ``options`` go to the source unchanged."""
    df.write.format(format).options(**options).mode(mode).save()


def verify_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every given table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
