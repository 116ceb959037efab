"""Column functions shared by the operators; all are built-in expressions."""

from snapmart.functions.numeric import (
    greatest_or_zero, percent_of, positive_ratio, round_half_away,
)
from snapmart.functions.temporal import (
    calendar_columns, hour_key, minutes_between_boundaries, partition_parts,
)
from snapmart.functions.labels import change_bucket, change_bucket_index, freshness_status

__all__ = [
    "calendar_columns", "change_bucket", "change_bucket_index", "freshness_status",
    "greatest_or_zero", "hour_key", "minutes_between_boundaries", "partition_parts",
    "percent_of", "positive_ratio", "round_half_away",
]
