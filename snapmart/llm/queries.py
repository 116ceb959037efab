"""One query per operator, each over its whole table with production settings."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from snapmart.llm import (
    binary, decontamination, html, licenses, mixing, phrases, quality, secrets, sharding, simhash, spelling, tokens,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]


ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python tasks find this package too where a session was started in another folder.

    On a cluster the package is shipped with the application; the path does no harm there.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def _ready(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every document."""
    return quality.quality_counts(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    return urls.judged(table(spark, sf_dir, "pages"))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block of every document that may be a license notice, and what it is."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes from every document."""
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every context limit means for the documents."""
    return tokens.context_report(tokens.encoded_lengths(table(spark, sf_dir, "documents")))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to files and read back."""
    return binary.stored_ids(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they overlap with."""
    return decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("mark")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its slot and shard, as written to the shards."""
    return sharding.sharded(table(spark, sf_dir, "documents"), "doc_id")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.secret_counts(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the vocabulary with its usual form."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def registry() -> dict[str, Query]:
    return {fn.__name__: _ready(fn) for fn in (
        op1_simhash, op2_quality_rules, op3_url_filters, op4_license_scans, op5_mixing,
        op6_token_counts, op7_token_ids, op8_decontamination, op9_sharding, op10_html_extraction,
        op11_phrases, op12_secrets, op13_spelling)}
