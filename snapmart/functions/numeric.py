"""Rounding and guarded division."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# From this magnitude on a double has no fractional part left to round.
_INTEGRAL = float(2 ** 53)


def round_half_away(x: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, halves away from zero, NULL and NaN kept."""
    shift = float(10 ** digits)
    scaled = F.abs(x) * shift
    rounded = F.signum(x) * F.floor(scaled + 0.5).cast("double") / shift
    return F.when(scaled < _INTEGRAL, rounded).otherwise(x)


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; NULL when ``whole`` is zero."""
    return F.try_divide(part, whole) * 100


def positive_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` where ``whole`` is positive, else NULL."""
    return F.when(whole > 0, F.try_divide(part, whole))


def greatest_or_zero(a: Column, b: Column) -> Column:
    """The larger of two values, a missing one counting as zero."""
    zero = F.lit(0.0)
    return F.greatest(F.coalesce(a, zero), F.coalesce(b, zero))
