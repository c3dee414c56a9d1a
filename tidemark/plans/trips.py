"""Taxi trips: the keyed trip table and the daily fares over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import quotient
from ..functions.times import date_text
from ..operators.merge import patch_items, put_items

KEY = ["trip_id"]
END_FIELDS = ["fare_amount", "tip_amount", "total_amount"]


def apply_starts(trips: DataFrame, starts: DataFrame, order_by: list[str]) -> DataFrame:
    """Put each started trip; a later start of the same trip replaces it."""
    return put_items(trips, starts, KEY, order_by)


def apply_ends(trips: DataFrame, ends: DataFrame, order_by: list[str]) -> DataFrame:
    """Set the fields an end brings, on trips that are known; others are skipped."""
    return patch_items(trips, ends, KEY, order_by=order_by, insert=False)


def skipped_ends(trips: DataFrame, ends: DataFrame) -> DataFrame:
    return ends.join(trips.select(*KEY), KEY, "left_anti").select(*ends.columns)


def daily_fares(trips: DataFrame) -> DataFrame:
    """Fares per pickup date; a trip without a fare counts as 0."""
    fare = F.coalesce(F.col("fare_amount"), F.lit(0).cast(trips.schema["fare_amount"].dataType))
    return (
        trips.select(date_text(F.col("pickup_datetime")).alias("date"), fare.alias("fare"))
        .groupBy("date")
        .agg(
            F.sum("fare").alias("total_fare"),
            F.count("*").alias("count_trips"),
            F.max("fare").alias("max_fare"),
            F.min("fare").alias("min_fare"),
            quotient(F.sum("fare"), F.count("*")).alias("average_fare"),
        )
    )
