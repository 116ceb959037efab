"""Gold layer storage.

The entity dimension is split into buckets by a hash of the entity's key. A load writes the
buckets it changes to a folder of its own, and then a list ``v=N`` of where every bucket
lies now; readers follow the newest list whose write finished, so they see all of a load
or nothing of it. The date dimension and the fact only grow, so they are appended to; the
fact is partitioned by day, with an index of its snapshot ids beside it.
"""

from __future__ import annotations

import time
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from snapmart.schemas import CONTRACTS, DIM_COIN, DIM_DATE, FACT, FACT_CONTRACT, FACT_PARTITION
from snapmart.sources.files import child_names, exists, modified, remove
from snapmart.sources.key_table import KeyTable

ENTITY_BUCKETS = 64
_BUCKET = "entity_bucket"
_LIST = "bucket int, load int, last_key bigint"


def entity_bucket() -> Column:
    return F.pmod(F.xxhash64("coin_id"), F.lit(ENTITY_BUCKETS)).cast("int")


def entity_buckets(rows: DataFrame) -> list[int]:
    """The buckets of the entity dimension that ``rows`` belong to; 64 at most."""
    return sorted(r[0] for r in rows.select(entity_bucket()).distinct().collect())


def stored_fact_schema() -> T.StructType:
    return T.StructType(FACT_CONTRACT.schema.fields + [T.StructField(FACT_PARTITION, T.DateType())])


class GoldStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _versions(self, table: str) -> list[int]:
        base = self.path(table)
        numbers = [n[2:] for n in child_names(self.spark, base) if n.startswith("v=")]
        return sorted(
            int(n) for n in numbers if exists(self.spark, f"{base}/v={n}/_SUCCESS"))

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _bucket_list(self) -> dict[int, tuple[int, int]]:
        """Load that wrote each bucket last, and the bucket's largest key."""
        versions = self._versions(DIM_COIN)
        if not versions:
            return {}
        rows = self.spark.read.schema(_LIST).parquet(f"{self.path(DIM_COIN)}/v={versions[-1]}").collect()
        return {r["bucket"]: (r["load"], r["last_key"]) for r in rows}

    def dim_coin(self, buckets: Collection[int] | None = None) -> DataFrame:
        """The entity dimension; with ``buckets`` only those, and no other file is opened."""
        base, schema = self.path(DIM_COIN), CONTRACTS[DIM_COIN].schema
        folders = [f"{base}/load={load}/{_BUCKET}={bucket}" for bucket, (load, _) in sorted(self._bucket_list().items())
                   if buckets is None or bucket in buckets]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def last_coin_sk(self) -> int:
        """The largest surrogate key given out, from the list of buckets."""
        return max((key for _, key in self._bucket_list().values()), default=0)

    def dim_date(self) -> DataFrame:
        return self._read(self.path(DIM_DATE), CONTRACTS[DIM_DATE].schema)

    def fact(self) -> DataFrame:
        return self._read(self.path(FACT), stored_fact_schema())

    def newest_fact(self) -> DataFrame:
        """The fact's newest day, found in the names of its folders; no other file is opened."""
        prefix = f"{FACT_PARTITION}="
        days = sorted((n for n in child_names(self.spark, self.path(FACT)) if n.startswith(prefix)), reverse=True)
        for day in days:
            # A failed write may leave a folder without files.
            if any(n.startswith("part-") for n in child_names(self.spark, f"{self.path(FACT)}/{day}")):
                value = F.lit(day.removeprefix(prefix)).cast("date")
                return self.fact().filter(F.col(FACT_PARTITION).eqNullSafe(value))
        return self.fact()

    def tables(self) -> dict[str, DataFrame]:
        return {FACT: self.fact(), DIM_COIN: self.dim_coin(), DIM_DATE: self.dim_date()}

    def replace_dim_coin(self, df: DataFrame, whole: bool = True) -> None:
        """Write the buckets that ``df`` has rows of, each complete, as a new version. The
        others stay as they are, or are dropped if ``df`` is the ``whole`` dimension.

        Replaced folders stay until :meth:`drop_old_versions`.
        """
        versions = self._versions(DIM_COIN)
        number = versions[-1] + 1 if versions else 1
        base = self.path(DIM_COIN)
        # What a failed write has left behind is in no list and is overwritten.
        df.withColumn(_BUCKET, entity_bucket()).hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(
            _BUCKET).parquet(f"{base}/load={number}")
        written = T.StructType([*CONTRACTS[DIM_COIN].schema, T.StructField(_BUCKET, T.IntegerType())])
        keys = self.spark.read.schema(written).parquet(f"{base}/load={number}").groupBy(_BUCKET).agg(
            F.max("coin_sk").alias("last_key")).collect()  # one row per bucket
        places = {} if whole else self._bucket_list()
        places |= {r[_BUCKET]: (number, r["last_key"]) for r in keys}
        rows = [(bucket, *place) for bucket, place in sorted(places.items())]
        self.spark.createDataFrame(rows, _LIST).coalesce(1).write.mode("overwrite").parquet(f"{base}/v={number}")

    def drop_old_versions(self, hours: float = 24.0) -> int:
        """Remove versions of the entity dimension replaced more than ``hours`` ago, which no
        report that began since can be reading, and the buckets that no version left names.
        Returns how many versions."""
        base, limit = self.path(DIM_COIN), time.time() - hours * 3600
        versions = self._versions(DIM_COIN)
        old = [a for a, b in zip(versions, versions[1:])
               if modified(self.spark, f"{base}/v={b}/_SUCCESS") < limit]
        kept = [f"{base}/v={n}" for n in versions if n not in old]
        if not old:
            return 0
        named = {(r["load"], r["bucket"]) for r in self.spark.read.schema(_LIST).parquet(*kept).distinct().collect()}
        for number in old:
            remove(self.spark, f"{base}/v={number}")
        loads = [int(n[5:]) for n in child_names(self.spark, base) if n.startswith("load=")]
        for number in (n for n in loads if n <= versions[-1]):  # a later one may be under way
            for folder in child_names(self.spark, f"{base}/load={number}"):
                if folder.startswith(f"{_BUCKET}=") and (number, int(folder.partition("=")[2])) not in named:
                    remove(self.spark, f"{base}/load={number}/{folder}")
        return len(old)

    def append_dim_date(self, df: DataFrame) -> None:
        # Most loads bring no new hour, and even an empty write would add a file.
        if not df.isEmpty():
            df.write.mode("append").parquet(self.path(DIM_DATE))

    def fact_keys(self) -> KeyTable:
        """The snapshot ids of the fact, by bucket."""
        return KeyTable(self.spark, self.path(FACT), ["snapshot_id"], self.fact)

    def append_fact(self, df: DataFrame) -> None:
        """Append rows; within a file they are sorted so row-group statistics can skip data.

        ``df`` is read twice and should be a stored table.
        """
        if df.isEmpty():
            return
        with self.fact_keys().adding(df):
            (
                df.withColumn(FACT_PARTITION, F.to_date("batch_ingested_at"))
                .hint("rebalance", FACT_PARTITION)
                .sortWithinPartitions(FACT_PARTITION, *FACT_CONTRACT.cluster_by)
                .write.mode("append").partitionBy(FACT_PARTITION).parquet(self.path(FACT))
            )
