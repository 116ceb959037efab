"""Ordered buckets and status labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- Fixed values: bucket bounds and labels, status labels --------------------
CHANGE_BUCKETS = (
    (10.0, "🚀 > +10%"),
    (5.0, "📈 +5% to +10%"),
    (0.0, "🟢 0% to +5%"),
    (-5.0, "🔴 -5% to 0%"),
)
LOWEST_BUCKET = "💀 < -5%"
FRESH = "✅ FRESH"
STALE = "⚠️ STALE — Check Poller"
# --- End of fixed values ------------------------------------------------------

UNKNOWN_BUCKET = "unknown"


def _ladder(x: Column, outcomes: list, lowest, missing) -> Column:
    steps = F.when(x.isNull(), missing)
    for (bound, _), outcome in zip(CHANGE_BUCKETS, outcomes):
        steps = steps.when(x >= bound, outcome)
    return steps.otherwise(lowest)


def change_bucket(pct: Column, missing_as_lowest: bool = False) -> Column:
    """Label of a percentage change; missing changes get a bucket of their own by default."""
    labels = [label for _, label in CHANGE_BUCKETS]
    return _ladder(pct, labels, LOWEST_BUCKET, LOWEST_BUCKET if missing_as_lowest else UNKNOWN_BUCKET)


def change_bucket_index(pct: Column, missing_as_lowest: bool = False) -> Column:
    """Position of the bucket, best change first."""
    last = len(CHANGE_BUCKETS)
    return _ladder(pct, list(range(last)), last, last if missing_as_lowest else last + 1)


def freshness_status(lag_minutes: Column, max_lag_minutes: int = 90) -> Column:
    return F.when(lag_minutes <= max_lag_minutes, FRESH).otherwise(STALE)
