"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from snapmart.sources.files import remove

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Rows of a few numbers that are worth a file of their own.
ROWS_A_FILE = 1 << 14


def get_spark(app_name: str = "snapmart") -> SparkSession:
    """Return the active session, or start one with the settings the library relies on."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def require_utc(spark: SparkSession) -> None:
    """Stored hours and folders are those of UTC; a session in another zone would mix them up."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone is {zone}; silver and gold are kept in UTC")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="snapmart-"))
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/snapmart"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch area."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows: int, per_file: int = ROWS_A_FILE) -> DataFrame:
    """``df``, of about ``rows`` rows, for writing: without a file for every shuffle partition.

    Every file that an executor creates costs calls to the store; Hadoop's local file system
    even starts processes for it (chmod), which count the executor's memory twice while
    they begin. The number of tasks grows with the rows, and is never raised.
    """
    return df.coalesce(rows // per_file + 1)


_scopes: list[list[str]] = []


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch area and return a scan of it.

    Cuts the lineage in a way that survives lost executors, and fixes the values
    of expressions such as the partition id that must not be evaluated twice. The
    table stays until the :func:`scratch_scope` around the call ends, or for as long as
    the scratch area does.
    """
    path = scratch_path(df.sparkSession, label)
    if _scopes:
        _scopes[-1].append(path)
    return _written(df, path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what :func:`materialise` writes within the block when the block ends.

    Frames built in the block have to be used in it::

        with scratch_scope(spark):
            reports.dominance(fact, coins, n=None).write.parquet(target)
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


@contextmanager
def materialised(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like :func:`materialise`, for use within a ``with`` block; removed afterwards."""
    path = scratch_path(df.sparkSession, label)
    try:
        yield _written(df, path)
    finally:
        remove(df.sparkSession, path)
