"""Ranks that keep ties.

Where a whole group may tie, ranking its rows in a window would bring the
group to one task. Here only the distinct values of a group are ranked, at
most k of them per task, and the rows are then held against the cut-off.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CUT = "__cut"
N = "__n"


def value_counts(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """How often each value occurs in each group."""
    return df.groupBy(*group, value).agg(F.count("*").alias(N))


def counts_within_rank(counts: DataFrame, group: list[str], value: str, k: int) -> DataFrame:
    """Values, with their counts, whose rows rank at most k, highest value first.

    A value ranks one behind all rows with a higher value. Each value stands
    for a row or more, so those behind the k-th value can be dropped at once.
    """
    down = Window.partitionBy(*group).orderBy(F.col(value).desc())
    higher = F.sum(N).over(down.rowsBetween(Window.unboundedPreceding, -1))
    return (
        counts.withColumn("__place", F.row_number().over(down)).filter(F.col("__place") <= k)
        .withColumn("__higher", F.coalesce(higher, F.lit(0)))
        .filter(F.col("__higher") < k)
        .drop("__place", "__higher")
    )


def cut_offs(kept: DataFrame, group: list[str], value: str) -> DataFrame:
    """Lowest value kept in each group."""
    return kept.groupBy(*group).agg(F.min(value).alias(CUT))


def at_or_above(df: DataFrame, cuts: DataFrame, group: list[str], value: str) -> DataFrame:
    """Rows whose value reaches the cut-off of their group; groups may be null."""
    named = cuts.select(*[F.col(c).alias(f"__cut_{c}") for c in group], CUT)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__cut_{c}")) for c in group])
    return df.join(named, same).filter(F.col(value) >= F.col(CUT)).select(*df.columns)


def within_rank(df: DataFrame, group: list[str], value: str, k: int) -> DataFrame:
    """Rows that rank at most k in their group, highest value first; ties all stay.

    The frame is read twice, so it should be a table or staged.
    """
    kept = counts_within_rank(value_counts(df, group, value), group, value, k)
    return at_or_above(df, cut_offs(kept, group, value), group, value)
