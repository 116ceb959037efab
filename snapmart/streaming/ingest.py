"""Structured Streaming: bronze folder to silver, silver to gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from snapmart.operators.dedup import drop_copies
from snapmart.operators.records import flatten_and_cast, keep_valid
from snapmart.plans.gold import load_gold
from snapmart.plans.silver import SNAPSHOT_KEY, deduplicate
from snapmart.schemas import PARTITION_COLUMNS, damaged_schema, silver_schema
from snapmart.sources.bronze import corrupt_envelopes, explode_records, stream_envelopes
from snapmart.sources.silver import append_silver, read_silver, write_silver
from snapmart.sources.triggers import read_triggers, write_trigger


# Tasks among which a trigger of :func:`start_first_seen_within` deals the rows of an hour.
TASKS_AN_HOUR = 4


def stream_rows(spark: SparkSession, bronze_path: str, layout: str = "documents",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Typed and valid rows of the landing folder, duplicates included."""
    envelopes = stream_envelopes(spark, bronze_path, layout, max_files_per_trigger)
    return explode_records(envelopes).transform(flatten_and_cast).transform(keep_valid)


def _started(writer, checkpoint: str, trigger: dict) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_first_seen(rows: DataFrame, silver_path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append each snapshot once, as first seen, however late it or a repeat arrives.

    What is stored is the only state. Batch jobs may append to the same folder.
    """
    writer = rows.writeStream.foreachBatch(lambda batch, _: append_silver(
        drop_copies(batch, SNAPSHOT_KEY), silver_path, SNAPSHOT_KEY))
    return _started(writer, checkpoint, trigger or {"processingTime": "1 minute"})


def first_seen_within(rows: DataFrame, lateness: str) -> DataFrame:
    """Each snapshot once, as first seen, with state for no longer than ``lateness``.

    A snapshot is forgotten once the watermark, the newest batch time seen less
    ``lateness``, has passed its batch time by ``lateness``. A row whose batch time lies
    behind the watermark is dropped, so no snapshot comes twice; :func:`dropped_as_late`
    counts such rows. Rows without a batch time cannot be placed and are left out.
    """
    dated = rows.filter(F.col("batch_ingested_at").isNotNull())
    return dated.withWatermark("batch_ingested_at", lateness).dropDuplicatesWithinWatermark(list(SNAPSHOT_KEY))


def start_first_seen_within(rows: DataFrame, silver_path: str, checkpoint: str, lateness: str = "1 day",
                            **trigger) -> StreamingQuery:
    """Append what :func:`first_seen_within` lets through; nothing stored is read again.

    Unlike :func:`start_first_seen`, what a trigger costs depends on the rows that arrive
    and on the snapshots of the last while, not on what silver holds. The folder belongs
    to this stream alone: the stream keeps a log in it, by which a trigger that is run
    again after a failure leaves its rows once. Read it with ``read_silver``.
    """
    # The state is dealt by key, so each of its tasks has rows of every hour; gathered by
    # hour, a trigger writes a few files per hour, not one from every task.
    share = F.pmod(F.xxhash64(*SNAPSHOT_KEY), F.lit(TASKS_AN_HOUR))
    gathered = first_seen_within(rows, lateness).repartition(*PARTITION_COLUMNS, share)
    writer = gathered.writeStream.format("parquet").partitionBy(*PARTITION_COLUMNS).option("path", silver_path)
    return _started(writer, checkpoint, trigger or {"processingTime": "1 minute"})


def dropped_as_late(query: StreamingQuery) -> int:
    """Rows that recent triggers of ``query`` dropped as they came behind the watermark,
    copies within a trigger counted once."""
    return sum(state["numRowsDroppedByWatermark"] for progress in query.recentProgress
               for state in progress["stateOperators"])


def start_landing(spark: SparkSession, bronze_path: str, rows_path: str, damaged_path: str, checkpoint: str,
                  layout: str = "documents", max_files_per_trigger: int | None = None, **trigger) -> StreamingQuery:
    """Store the landing folder as it arrives: typed valid rows, the latest per snapshot and
    trigger, and beside them the envelopes that could not be parsed in full.

    The readable part of a damaged envelope counts like any other. Either sink has a
    folder per trigger that is written whole, so a trigger that failed between the two
    and is run again leaves every row and every damaged envelope once.
    """
    def land(envelopes: DataFrame, number: int) -> None:
        # Two sinks of one trigger: the files are read once.
        held = envelopes.persist()
        try:
            rows = explode_records(held).transform(flatten_and_cast).transform(keep_valid)
            write_trigger(deduplicate(rows), rows_path, number, PARTITION_COLUMNS)
            write_trigger(corrupt_envelopes(held), damaged_path, number)
        finally:
            held.unpersist()

    writer = stream_envelopes(spark, bronze_path, layout, max_files_per_trigger).writeStream.foreachBatch(land)
    return _started(writer, checkpoint, trigger or {"processingTime": "1 minute"})


def read_landed(spark: SparkSession, rows_path: str) -> DataFrame:
    """The latest valid row per snapshot out of all finished triggers of a landing."""
    return deduplicate(read_triggers(spark, rows_path, silver_schema()))


def read_damaged(spark: SparkSession, damaged_path: str) -> DataFrame:
    """(ingestion_id, text) of the damaged envelopes of all finished triggers."""
    return read_triggers(spark, damaged_path, damaged_schema())


def start_keep_latest(rows: DataFrame, versions_path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append every batch's latest valid row per snapshot to ``versions_path``.

    Files are only added, so another stream may read the folder meanwhile, and what a
    batch writes does not grow with what is stored. Read it with :func:`read_latest`,
    and compact hours that are closed with :func:`compact`. A batch that is written
    twice changes nothing.
    """
    writer = rows.writeStream.foreachBatch(lambda batch, _: write_silver(
        deduplicate(batch), versions_path, mode="append"))
    return _started(writer, checkpoint, trigger or {"processingTime": "1 minute"})


def read_latest(spark: SparkSession, versions_path: str, since=None, until=None) -> DataFrame:
    """The latest valid row per snapshot out of all versions, however late they arrived."""
    return deduplicate(read_silver(spark, versions_path, since, until))


def compact(spark: SparkSession, versions_path: str, silver_path: str, since=None, until=None) -> None:
    """Write the latest rows of a time range to ``silver_path``, replacing the hours touched.

    Versions stay where they are. A range has to begin and end on the hour.
    """
    write_silver(read_latest(spark, versions_path, since, until), silver_path, touched_partitions_only=True)


def stream_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """Stored silver as a stream of newly written files."""
    return spark.readStream.schema(silver_schema()).parquet(silver_path)


def start_gold_refresh(silver_rows: DataFrame, root: str, checkpoint: str, as_of=None,
                       **trigger) -> StreamingQuery:
    """Load every arriving set of silver rows into gold; repeated rows are ignored there."""
    writer = silver_rows.writeStream.foreachBatch(lambda batch, _: load_gold(batch, root, as_of))
    return _started(writer, checkpoint, trigger or {"processingTime": "1 hour"})
