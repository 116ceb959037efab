"""Bronze layer: JSON envelopes, each holding one batch (or a part of one) of records.

Two layouts are supported. ``documents`` is one (possibly multi-line) envelope per
file. ``lines`` is one envelope per line, many to a file; Spark can split such
files, so it is the layout for bulk data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapmart.functions.temporal import hour_number, padded_partition_parts
from snapmart.schemas import CORRUPT, PARTITION_COLUMNS, envelope_schema

LAYOUTS = ("documents", "lines")


def _check(layout: str) -> None:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")


def _options(layout: str) -> dict:
    _check(layout)
    return {"multiLine": layout == "documents", "columnNameOfCorruptRecord": CORRUPT}


def read_envelopes(spark: SparkSession, path: str, layout: str = "documents",
                   since=None, until=None) -> DataFrame:
    """Envelopes below ``path`` under a declared schema, damaged ones included.

    With ``since`` or ``until`` only the hour folders of ``[since, until)`` are read
    (the hour of ``until`` only if it lies within it); ``path`` must then be laid out in
    year/month/day/hour folders. Without either, any folder below ``path`` is read.
    ``record_count`` is that of the envelope, which may be a part of a batch.
    """
    reader = spark.read.options(**_options(layout))
    if since is None and until is None:
        return reader.schema(envelope_schema()).option("recursiveFileLookup", True).json(path)
    folders = [T.StructField(c, T.IntegerType()) for c in PARTITION_COLUMNS]
    df = reader.schema(T.StructType([*envelope_schema(), *folders])).json(path)
    y, m, d, h = (F.col(c) for c in PARTITION_COLUMNS)
    folder = ((y * 100 + m) * 100 + d) * 100 + h
    if since is not None:
        df = df.filter(folder >= hour_number(F.lit(since).cast("timestamp")))
    if until is not None:
        last = F.lit(until).cast("timestamp") - F.expr("interval 1 microsecond")
        df = df.filter(folder <= hour_number(last))
    return df.drop(*PARTITION_COLUMNS)


def stream_envelopes(spark: SparkSession, path: str, layout: str = "documents",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """The landing folder as a stream of envelopes."""
    reader = (
        spark.readStream.schema(envelope_schema()).options(**_options(layout))
        .option("recursiveFileLookup", True)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def corrupt_envelopes(envelopes: DataFrame) -> DataFrame:
    """Envelopes that could not be parsed in full, with the text that was found.

    Spark refuses to count raw JSON by this column alone: collect or write the rows.
    """
    return envelopes.filter(F.col(CORRUPT).isNotNull()).select("ingestion_id", CORRUPT)


def explode_records(envelopes: DataFrame) -> DataFrame:
    """One row per record; a batch without records disappears."""
    return envelopes.select(
        "ingestion_id",
        F.col("ingested_at").alias("batch_ingested_at"),
        F.explode("data").alias("coin"),
    )


def read_bronze(spark: SparkSession, path: str, layout: str = "documents",
                since=None, until=None) -> DataFrame:
    """Records of the envelopes below ``path``; the bounds as in :func:`read_envelopes`."""
    return explode_records(read_envelopes(spark, path, layout, since, until))


def build_envelopes(records: DataFrame, source: str, max_records: int = 10_000) -> DataFrame:
    """Pack (ingestion_id, batch_ingested_at, coin) rows into envelopes.

    A batch larger than ``max_records`` becomes several envelopes with the same
    ingestion id, so no array grows with the data. Records with more copies than that
    are counted and split into runs, which keeps them from landing in one envelope;
    they are found by hash, so whole records are shuffled once.
    """
    batch = ["ingestion_id", "batch_ingested_at"]
    of_batch = [F.col(f"_{c}") for c in batch]
    same_batch = [F.equal_null(F.col(c), k) for c, k in zip(batch, of_batch)]
    mark = F.xxhash64("coin")
    counts = records.groupBy(*[F.col(c).alias(f"_{c}") for c in batch], mark.alias("_mark")).agg(
        F.count("*").alias("_copies"))
    # One row per batch, and one per record with so many copies.
    parts = F.broadcast(counts.groupBy(*of_batch).agg(
        F.ceil(F.sum("_copies") / F.lit(max_records)).cast("int").alias("parts")))
    crowds = F.broadcast(counts.filter(F.col("_copies") > max_records).drop("_copies"))
    in_crowd = [*same_batch, mark == F.col("_mark")]
    runs = (
        records.join(crowds, in_crowd, "left_semi")
        .groupBy(*batch, "coin").agg(F.count("*").alias("copies"))
        .withColumn("run", F.explode(F.sequence(
            F.lit(0), F.floor((F.col("copies") - 1) / F.lit(max_records)).cast("int"))))
        .withColumn("copies", F.least(
            F.lit(max_records), F.col("copies") - F.col("run") * F.lit(max_records)).cast("int"))
    )
    single = records.join(crowds, in_crowd, "left_anti").select(
        *batch, "coin", F.lit(1).alias("copies"), F.lit(0).alias("run"))
    return (
        single.unionByName(runs).join(parts, same_batch)
        .withColumn("part", F.pmod(F.xxhash64("coin", "run"), F.col("parts")))
        .groupBy(*batch, "part")
        .agg(F.flatten(F.collect_list(F.array_repeat("coin", F.col("copies")))).alias("data"))
        .select(
            "ingestion_id",
            F.lit(source).alias("source"),
            F.date_format("batch_ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ingested_at"),
            F.size("data").alias("record_count"),
            "data",
            *[c.alias(n) for n, c in padded_partition_parts(F.col("batch_ingested_at")).items()],
        )
    )


def write_bronze(envelopes: DataFrame, path: str, layout: str = "documents",
                 mode: str = "append", compression: str | None = None,
                 envelopes_a_file: int = 200) -> None:
    """Write envelopes below ``path`` in zero-padded year/month/day/hour folders.

    Spark reads a compressed file in one task, so files of lines with a ``compression``
    (such as ``gzip``) hold no more than ``envelopes_a_file``.
    """
    _check(layout)
    # One or few tasks per hour, so that an hour does not get a file from every task.
    writer = envelopes.hint("rebalance", *PARTITION_COLUMNS).write.mode(mode).partitionBy(*PARTITION_COLUMNS)
    if layout == "documents":
        writer = writer.option("maxRecordsPerFile", 1)
    elif compression:
        writer = writer.option("maxRecordsPerFile", envelopes_a_file)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)
