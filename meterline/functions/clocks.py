"""Elapsed time, speed and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds: each end is floored to its second first."""
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def elapsed_micros(start: Column | str, end: Column | str) -> Column:
    return F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))


def duration(start: Column | str, end: Column | str) -> Column:
    """The difference as a day-time interval."""
    return _col(end) - _col(start)


def miles_per_hour(miles: Column | str, seconds: Column | str) -> Column:
    """NULL where no whole second elapsed, since no speed is known there."""
    return F.try_divide(_col(miles), _col(seconds)) * 3600


def calendar_parts(ts: Column | str, *parts: str) -> dict[str, Column]:
    """Columns named year, month, day or hour, taken from one timestamp."""
    readers = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
    return {part: readers[part](_col(ts)) for part in parts}
