"""Tables laid out by entity, so that joins and histories per entity need no shuffle.

The fact and the entity dimension are stored in the same number of buckets of the same
key, and sorted by it. A join on the key then reads bucket by bucket, and a window per
entity finds each entity's rows together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 64
KEY = "coin_sk"


def write_bucketed(df: DataFrame, table: str, key: str = KEY, sort: Sequence[str] = (), buckets: int = BUCKETS) -> None:
    """Save ``df`` as catalog table ``table`` in ``buckets`` buckets of ``key``, a file each.

    Rows are dealt out by the same hash before they are written, so no task writes to
    all buckets. An entity's rows are one task's; for histories too large for that, the
    reports' sliced path cuts them.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *sort).saveAsTable(table)


def store_by_entity(fact: DataFrame, dim_coin: DataFrame, prefix: str, buckets: int = BUCKETS) -> tuple[str, str]:
    """Store fact and entity dimension by entity; returns the names of the two tables."""
    names = f"{prefix}_fact", f"{prefix}_coin"
    write_bucketed(fact, names[0], sort=["batch_ingested_at", "snapshot_id"], buckets=buckets)
    write_bucketed(dim_coin, names[1], buckets=buckets)
    return names


def read_by_entity(spark: SparkSession, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Fact and entity dimension as :func:`store_by_entity` has stored them."""
    return spark.table(f"{prefix}_fact"), spark.table(f"{prefix}_coin")


def drop_by_entity(spark: SparkSession, prefix: str) -> None:
    for name in (f"{prefix}_fact", f"{prefix}_coin"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
