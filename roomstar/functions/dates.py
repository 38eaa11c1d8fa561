"""Calendar and interval column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """yyyymmdd as an int, e.g. 2024-01-07 -> 20240107."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def day_of_week(d) -> Column:
    """0 = Sunday .. 6 = Saturday (Spark's dayofweek counts from 1)."""
    return (F.dayofweek(_c(d)) - 1).cast("long")


def is_weekend(d) -> Column:
    return day_of_week(d).isin(0, 6)


def year_month(d) -> Column:
    """Month partition value, e.g. 2024-01-07 -> 202401."""
    return (F.year(_c(d)) * 100 + F.month(_c(d))).cast("int")


def seconds_between(start, end) -> Column:
    """end - start in fractional seconds; null if either side is null."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1_000_000.0)


def month_bounds(lo: str, hi: str) -> tuple[int, int]:
    """yyyymm of two ISO dates, for adding partition predicates to a date range."""
    return int(lo[:4]) * 100 + int(lo[5:7]), int(hi[:4]) * 100 + int(hi[5:7])
