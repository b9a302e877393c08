"""Time helpers, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: Column | str) -> Column:
    return F.unix_micros(_col(ts))


def floor_to(ts: Column | str, seconds: int) -> Column:
    """Start of the cadence bucket a timestamp falls into."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(_col(ts)) / F.lit(seconds)) * F.lit(seconds))


def from_unix(x: Column | str) -> Column:
    """Unix seconds (number or digits) to a timestamp, fraction dropped."""
    return F.timestamp_seconds(_col(x).cast("double").cast("bigint"))


def instant(text: Column | str) -> Column:
    """ISO-8601 text to an instant; unreadable text gives NULL."""
    return F.try_to_timestamp(_col(text))


def whole_minutes(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed between two instants."""
    minute = lambda c: F.floor(F.unix_seconds(_col(c)) / F.lit(60))
    return minute(end) - minute(start)


def iso_utc(ts: Column | str) -> Column:
    """``2024-01-31T10:00:00Z``; NULL stays NULL."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")
