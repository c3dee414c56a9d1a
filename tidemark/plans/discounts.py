"""Cart discounts for users with enough past spending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import whole_part_above
from ..operators.joins import join_static

SPENDING_LIMIT = 100
DISCOUNT_PERCENTAGE = 30


def spending(history: DataFrame, order_by: str | None = None) -> DataFrame:
    """One row per user. Of several rows of a user the last by ``order_by``
    counts; without an order the job fails, as none of them is the right one."""
    if order_by is not None:
        total = F.max_by("total_amount_spent", order_by)
    else:
        several = F.concat(F.lit("several spending rows of user "), F.col("user_id").cast("string"))
        total = F.when(F.count("*") > 1, F.raise_error(several)).otherwise(F.first("total_amount_spent"))
    return history.groupBy("user_id").agg(total.alias("total_amount_spent"))


def user_discounts(
    events: DataFrame, history: DataFrame, limit: int = SPENDING_LIMIT, order_by: str | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """One row per event of a user whose spending, fraction cut off, is above the limit.

    Works on a batch and on a stream of events. ``history`` is reduced to one
    row per user (see ``spending``); store it first when a stream joins it, or
    every micro-batch computes it again. ``seen`` are earlier events, from which
    the join of a stream learns its hot users.
    """
    spenders = spending(history, order_by).filter(whole_part_above(F.col("total_amount_spent"), limit)).select("user_id")
    return join_static(events, spenders, ["user_id"], "left_semi", history=seen).select(
        "user_id", F.lit(DISCOUNT_PERCENTAGE).alias("discount_percentage")
    )
