"""Words, hashes and numbers that several operators share; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

# A word is a run of characters other than space and the controls 09 to 0D.
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of ``text`` in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def long_table(values: Iterable[int]) -> Column:
    """A constant array of integers, built once per query when the plan is optimised.

    For tables with a fixed number of entries only: it is sent along with the plan.
    """
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
