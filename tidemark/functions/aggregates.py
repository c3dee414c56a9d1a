"""Aggregate expressions.

Sums stay in the type of their input, so that totals over decimals and whole
numbers are exact and do not depend on the order rows arrive in; division into
a double is the last step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quotient(total: Column, n: Column) -> Column:
    """total / n as a double; null when n is 0 or null."""
    return total.cast("double") / F.when(n != 0, n).cast("double")


def mean(value: Column) -> Column:
    """Average of the non-null values, over an exact sum."""
    return quotient(F.sum(value), F.count(value))


def distinct_share(value: Column, condition: Column) -> Column:
    """Distinct values that meet the condition, as a share of all distinct values."""
    return quotient(F.count_distinct(F.when(condition, value)), F.count_distinct(value))


def diversity(value: Column) -> Column:
    """Distinct values over all values."""
    return quotient(F.count_distinct(value), F.count(value))


def most_frequent(label: Column, n: Column, when: Column | None = None) -> Column:
    """Label with the largest count; the smallest label wins a tie."""
    order = F.struct((-n).alias("n"), label.alias("label"))
    return F.min_by(label, order if when is None else F.when(when, order))
