"""MERGE-like operators for plain files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A merge rule builds a column from (stored value, incoming value).
Rule = Callable[[Column, Column], Column]


def take_incoming(stored: Column, incoming: Column) -> Column:
    return incoming


def keep_stored(stored: Column, incoming: Column) -> Column:
    return stored


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key ``target`` lacks; a NULL key never matches."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def update_matched(target: DataFrame, source: DataFrame, key: str, rules: dict[str, Rule]) -> DataFrame:
    """Every row of ``target``, columns named in ``rules`` merged where ``source`` has the key.

    ``source`` must hold each key once.
    """
    incoming = source.select(F.col(key).alias("_key"), *[
        F.col(c).alias(f"_new_{c}") for c in rules if c in source.columns])
    matched = F.col("_key").isNotNull()
    merged = {
        c: F.when(matched, rule(F.col(c), F.col(f"_new_{c}") if c in source.columns else F.lit(None)))
        .otherwise(F.col(c))
        for c, rule in rules.items()
    }
    return (
        target.join(incoming, target[key] == F.col("_key"), "left")
        .select(*[merged[c].alias(c) if c in merged else F.col(c) for c in target.columns])
    )
