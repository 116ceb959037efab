"""Bronze to silver, and the quality run on silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from snapmart.operators.dedup import keep_latest
from snapmart.operators.quality import Rule, build_report, default_rules, run_checks, write_report
from snapmart.operators.records import flatten_and_cast, keep_valid, validity
from snapmart.schemas import CORRUPT
from snapmart.sources.bronze import explode_records, read_envelopes
from snapmart.sources.silver import append_silver, read_silver, write_silver

SNAPSHOT_KEY = ("ingestion_id", "coin_id")


def deduplicate(df: DataFrame) -> DataFrame:
    """One row per entity and batch: the one updated last."""
    return keep_latest(df, SNAPSHOT_KEY, ["last_updated"])


def to_silver(records: DataFrame) -> DataFrame:
    """Raw records to clean silver rows."""
    return records.transform(flatten_and_cast).transform(deduplicate).transform(keep_valid)


def run_bronze_to_silver(spark: SparkSession, bronze_path: str, silver_path: str,
                         layout: str = "documents", mode: str = "overwrite",
                         since=None, until=None) -> dict[str, int]:
    """Build silver from bronze in one pass; returns the rows seen, kept and dropped, and
    how many envelopes were damaged (their readable part is used).

    ``since`` and ``until`` take only the hour folders of that range; for ``refresh`` and
    ``append``, as ``overwrite`` would drop the rest of silver.

    ``overwrite`` replaces silver, ``refresh`` replaces only the hours found in
    bronze, ``append`` adds rows not stored yet.
    """
    counts = Observation("silver")
    damage = Observation("bronze")
    if mode == "overwrite" and (since is not None or until is not None):
        raise ValueError("a time range needs mode='refresh' or 'append'")
    envelopes = read_envelopes(spark, bronze_path, layout, since, until).observe(
        damage, F.count_if(F.col(CORRUPT).isNotNull()).alias("damaged"))
    rows = (
        explode_records(envelopes)
        .transform(flatten_and_cast).transform(deduplicate)
        .observe(counts, F.count("*").alias("seen"), F.count_if(validity()).alias("kept"))
        .transform(keep_valid)
    )
    if mode == "append":
        append_silver(rows, silver_path, SNAPSHOT_KEY)
    elif mode == "refresh":
        write_silver(rows, silver_path, touched_partitions_only=True)
    elif mode == "overwrite":
        write_silver(rows, silver_path)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    seen = counts.get
    return {"seen": seen["seen"], "kept": seen["kept"], "dropped": seen["seen"] - seen["kept"],
            "damaged": damage.get["damaged"]}


def run_quality_on_silver(spark: SparkSession, silver_path: str, report_path: str | None = None,
                          rules: Sequence[Rule] | None = None, as_of: Column | None = None,
                          dataset: str = "silver_layer") -> DataFrame:
    """Check silver; returns the one-row report and, given a path, stores it."""
    silver = read_silver(spark, silver_path)
    report = build_report(run_checks(silver, rules or default_rules(), as_of), dataset, as_of)
    if report_path is not None:
        write_report(report, report_path)
    return report
