"""Quality of a growing silver table from partial states per hour.

A run over all of silver costs more every day. Here each hour keeps what the rules need of
it: counts of failing rows, the newest time, and the different values of the rules about
distinct values. A refresh reads the hours that were written and replaces their states;
verdicts are merged from states alone and equal those of a run over all of silver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapmart.operators.quality import (
    _DISTINCT_RULES, _ROW_RULES, Rule, distinct_rows, measures, verdicts_of,
)
from snapmart.schemas import PARTITION_COLUMNS
from snapmart.sources.silver import read_silver


class QualityState:
    """States of ``rules`` per hour of silver, stored below ``path``.

    Rows without a batch time lie in a folder of their own, which every refresh reads.
    """

    def __init__(self, spark: SparkSession, path: str, rules: Sequence[Rule]):
        self.spark, self.path, self.rules = spark, path.rstrip("/"), list(rules)

    def _folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def _distinct(self) -> list[tuple[int, Rule]]:
        return [(i, rule) for i, rule in enumerate(self.rules) if rule.kind in _DISTINCT_RULES]

    def refresh(self, silver_path: str, since=None, until=None) -> None:
        """Work out the states of the hours in ``[since, until)`` anew, of all without
        bounds. Bounds have to be on the hour, so that states are of whole hours."""
        rows = hours_read(self.spark, silver_path, since, until)
        counts = rows.groupBy(*PARTITION_COLUMNS).agg(*measures(self.rules))
        self._replace(counts, "rows")
        for i, rule in self._distinct():
            self._replace(rows.select(*PARTITION_COLUMNS, *[c for c in rule.columns if c not in PARTITION_COLUMNS])
                          .distinct(), f"values{i}")

    def _replace(self, states: DataFrame, name: str) -> None:
        states.hint("rebalance", *PARTITION_COLUMNS).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*PARTITION_COLUMNS).parquet(self._folder(name))

    def _stored(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._folder(name))

    def measured(self) -> DataFrame:
        """One row with the merged measures of all stored hours."""
        newest = {i for i, rule in enumerate(self.rules) if rule.kind == "FRESHNESS"}
        merged = [F.coalesce(F.sum("total"), F.lit(0)).alias("total")]
        for i, rule in enumerate(self.rules):
            if rule.kind in _ROW_RULES:
                merged.append(F.coalesce(F.sum(f"m{i}"), F.lit(0)).alias(f"m{i}"))
            elif i in newest:
                merged.append(F.max(f"m{i}").alias(f"m{i}"))
        return self._stored("rows").agg(*merged).withColumns({
            f"m{i}": distinct_rows(self._stored(f"values{i}"), rule.columns).scalar()
            for i, rule in self._distinct()})

    def verdicts(self, as_of: Column | None = None) -> DataFrame:
        """Verdict of every rule, in rule order, as of a run over all of silver."""
        return verdicts_of(self.measured(), self.rules, as_of)


def hours_read(spark: SparkSession, silver_path: str, since=None, until=None) -> DataFrame:
    """Silver rows of the given hours, and those without a batch time; other folders are not
    opened."""
    if since is None and until is None:
        return read_silver(spark, silver_path)
    undated = reduce(Column.__and__, [F.col(c).isNull() for c in PARTITION_COLUMNS])
    return read_silver(spark, silver_path, since, until).unionByName(
        read_silver(spark, silver_path).filter(undated))
