"""Hour keys, calendar attributes and minute arithmetic (session zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_WEEKEND = (0, 6)  # 0 = Sunday


def hour_key(ts: Column) -> Column:
    """The hour of ``ts`` as the number YYYYMMDDHH."""
    day = F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)
    return day.cast("bigint") * 100 + F.hour(ts)


def partition_parts(ts: Column) -> dict[str, Column]:
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts)}


def padded_partition_parts(ts: Column) -> dict[str, Column]:
    """Partition columns as zero-padded text, so paths read ``month=06``."""
    return {
        "year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"), "hour": F.date_format(ts, "HH"),
    }


def calendar_columns(hour: Column) -> dict[str, Column]:
    """Attributes of the hourly date dimension, given a time truncated to the hour."""
    weekday = F.dayofweek(hour) - 1
    return {
        "date_sk": hour_key(hour),
        "snapshot_hour": hour,
        "date_actual": F.to_date(hour),
        "year": F.year(hour),
        "quarter": F.quarter(hour),
        "month": F.month(hour),
        "month_name": F.monthname(hour),
        "day_of_month": F.dayofmonth(hour),
        "day_of_week": weekday,
        "day_name": F.dayname(hour),
        "hour_of_day": F.hour(hour),
        "is_weekend": weekday.isin(*_WEEKEND),
    }


def minutes_between_boundaries(start: Column, end: Column) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``."""
    def minute(ts: Column) -> Column:
        return F.floor(F.unix_micros(ts) / F.lit(60_000_000))
    return minute(end) - minute(start)


def hour_number(ts: Column) -> Column:
    """The hour of a timestamp as YYYYMMDDHH, built like the folder columns."""
    p = partition_parts(ts)
    return ((p["year"] * 100 + p["month"]) * 100 + p["day"]) * 100 + p["hour"]
