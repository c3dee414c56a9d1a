"""Number conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_money(value: Column) -> Column:
    """Two-place decimal, rounded half up; null where it does not convert."""
    return value.try_cast("decimal(18,2)")


def to_ratio(value: Column) -> Column:
    """Six-place decimal, rounded half up; null where it does not convert."""
    return value.try_cast("decimal(18,6)")


def lenient_double(text: Column) -> Column:
    """Double of a text; null where the text is no number."""
    return text.try_cast("double")


def whole_part_above(value: Column, limit: int) -> Column:
    """Compare after the fraction is cut off: 100.99 is not above 100."""
    return value.cast("bigint") > F.lit(limit)
