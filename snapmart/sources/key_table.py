"""Stored keys of a growing table, laid out so that a load reads only the keys it may meet.

Beside the table lies a folder with its keys, one sub-folder per bucket by a hash of the
key. A load works out the buckets of its own keys, reads those and no others, and appends
to them what it adds to the table. The day or hour a key was stored under plays no part,
so a key that comes again under another time is found like any other.

The folder is only an index. A marker stands while a load is under way; if one is found, or
no index at all, it is built anew from the table, the only time that is read in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapmart.sources.files import exists, remove, touch

FOLDER = "_keys"
BUCKETS = 256
_BUCKET = "key_bucket"


class KeyTable:
    """Keys of the table at ``table_path``; Spark does not see the folder as part of it.

    ``read_table`` returns the table's rows, for building the index.
    """

    def __init__(self, spark: SparkSession, table_path: str, columns: Sequence[str],
                 read_table: Callable[[], DataFrame], buckets: int = BUCKETS):
        self.spark, self.columns, self.read_table, self.buckets = spark, list(columns), read_table, buckets
        self.root = f"{table_path.rstrip('/')}/{FOLDER}"
        # The number of buckets is part of the place: another number is another index.
        self.path = f"{self.root}/of{buckets}"
        self.marker = f"{self.root}/under_way"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.columns), F.lit(self.buckets)).cast("int")

    def _with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.columns, self.bucket().alias(_BUCKET))

    def _ready(self) -> None:
        if exists(self.spark, self.marker) or not exists(self.spark, f"{self.path}/_SUCCESS"):
            remove(self.spark, self.root)
            self._write(self.read_table(), "overwrite")

    def _write(self, rows: DataFrame, mode: str) -> None:
        self._with_bucket(rows).hint("rebalance", _BUCKET).write.mode(mode).partitionBy(_BUCKET).parquet(self.path)

    def of_buckets(self, rows: DataFrame) -> DataFrame:
        """The stored keys in the buckets that ``rows`` touch."""
        self._ready()
        # At most ``buckets`` numbers.
        touched = sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())
        stored = self.spark.read.schema(self._with_bucket(rows).schema).parquet(self.path)
        return stored.filter(F.col(_BUCKET).isin(touched))

    def absent(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is not stored. A NULL in a key is a value like any other.

        ``rows`` is read twice and should be a stored table.
        """
        known = self.of_buckets(rows).select(
            F.col(_BUCKET).alias("_known_bucket"), *[F.col(c).alias(f"_known_{c}") for c in self.columns])
        match = [self.bucket() == F.col("_known_bucket")]
        match += [F.equal_null(F.col(c), F.col(f"_known_{c}")) for c in self.columns]
        return rows.join(known, match, "left_anti")

    @contextmanager
    def adding(self, rows: DataFrame) -> Iterator[None]:
        """Append the keys of ``rows`` after the block has appended the rows themselves::

            with keys.adding(rows):
                rows.write.mode("append").parquet(table_path)
        """
        self._ready()
        touch(self.spark, self.marker)
        yield
        self._write(rows, "append")
        remove(self.spark, self.marker)

    def forget(self) -> None:
        """Drop the index, as the table is changed in another way than by ``adding``."""
        remove(self.spark, self.root)

    def compact(self) -> None:
        """Build the index anew, with one or few files per bucket."""
        self.forget()
        self._ready()
