"""Dates, hours, durations and timestamp parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_PATTERN = "yyyy-MM-dd HH:mm:ss"


def date_text(text: Column) -> Column:
    """The yyyy-MM-dd part of a timestamp given as text."""
    return F.substring(text, 1, 10)


def hour_label(ts: Column) -> Column:
    """Two-digit hour, as used to lay out files by hour."""
    return F.date_format(ts, "HH")


def parse_timestamp(text: Column, pattern: str = SECOND_PATTERN) -> Column:
    """Timestamp by pattern; text that does not fit gives null."""
    return F.try_to_timestamp(text, F.lit(pattern))


def strip_utc(text: Column) -> Column:
    return F.regexp_replace(text, " UTC$", "")


def clock_time_on(base_date: str, clock: Column) -> Column:
    """Timestamp of a time of day on a given day."""
    return parse_timestamp(F.concat(F.lit(f"{base_date} "), clock))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end; negative when end comes first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(3600)


def ms_to_seconds(ms: Column) -> Column:
    return ms / F.lit(1000)
