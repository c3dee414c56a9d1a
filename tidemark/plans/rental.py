"""Vehicle rental metrics by day, user, pickup location and vehicle type.

``transactions``: user_id, vehicle_id, pickup_location, rental_start_time,
rental_end_time, total_amount. Rows are collapsed on the join keys before they
meet a dimension, so a busy user, place or vehicle never reaches one task row
by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import quotient
from ..functions.times import seconds_between

SECONDS_PER_HOUR = 3600


def _parts() -> list[Column]:
    """Partial sums from which every metric below can be put together."""
    seconds = seconds_between(F.col("rental_start_time"), F.col("rental_end_time"))
    return [
        F.count("*").alias("n"),
        F.sum("total_amount").alias("amount"),
        F.count("total_amount").alias("amounts"),
        F.max("total_amount").alias("max_amount"),
        F.min("total_amount").alias("min_amount"),
        F.sum(seconds).alias("seconds"),
        F.count(seconds).alias("durations"),
        F.max(seconds).alias("max_seconds"),
        F.min(seconds).alias("min_seconds"),
    ]


def _mean_amount() -> Column:
    return quotient(F.sum("amount"), F.sum("amounts"))


def _hours(seconds: Column) -> Column:
    return seconds / F.lit(SECONDS_PER_HOUR)


def _mean_hours() -> Column:
    return _hours(quotient(F.sum("seconds"), F.sum("durations")))


def transaction_metrics(transactions: DataFrame, users: DataFrame) -> DataFrame:
    """Per one-day window of the rental start, over transactions of known users."""
    day = F.window(F.col("rental_start_time"), "1 day")["start"]
    per_user_day = (
        transactions.withColumn("rental_date", day).groupBy("user_id", "rental_date").agg(*_parts())
    )
    return (
        per_user_day.join(users.select("user_id"), "user_id")
        .groupBy("rental_date")
        .agg(
            F.sum("n").alias("total_transactions"),
            F.sum("amount").alias("total_revenue"),
            _mean_amount().alias("average_transaction_value"),
            _hours(F.max("max_seconds")).alias("max_rental_duration"),
            _hours(F.min("min_seconds")).alias("min_rental_duration"),
            _mean_hours().alias("avg_rental_duration"),
        )
    )


def user_metrics(transactions: DataFrame, users: DataFrame) -> DataFrame:
    per_user = transactions.groupBy("user_id").agg(*_parts())
    return (
        per_user.join(users.select("user_id"), "user_id")
        .groupBy("user_id")
        .agg(
            F.sum("n").alias("total_user_transactions"),
            F.sum("amount").alias("user_total_revenue"),
            _mean_amount().alias("average_user_spending"),
            _hours(F.sum("seconds")).alias("total_user_rental_hours"),
            F.max("max_amount").alias("max_user_spending"),
            F.min("min_amount").alias("min_user_spending"),
        )
    )


def _by_place_and_vehicle(
    transactions: DataFrame, locations: DataFrame, vehicles: DataFrame
) -> DataFrame:
    return (
        transactions.groupBy("pickup_location", "vehicle_id")
        .agg(*_parts())
        .join(
            locations.select(F.col("location_id")), F.col("pickup_location") == F.col("location_id")
        )
        .join(vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id")
    )


def location_performance(
    transactions: DataFrame, locations: DataFrame, vehicles: DataFrame
) -> DataFrame:
    return (
        _by_place_and_vehicle(transactions, locations, vehicles)
        .groupBy("location_id")
        .agg(
            F.sum("amount").alias("location_total_revenue"),
            F.sum("n").alias("location_total_transactions"),
            _mean_amount().alias("average_transaction_amount_at_location"),
            F.max("max_amount").alias("max_transaction_amount"),
            F.min("min_amount").alias("min_transaction_amount"),
            F.count_distinct("vehicle_id").alias("unique_vehicles_used_at_location"),
        )
    )


def vehicle_type_performance(
    transactions: DataFrame, locations: DataFrame, vehicles: DataFrame
) -> DataFrame:
    return (
        _by_place_and_vehicle(transactions, locations, vehicles)
        .groupBy("vehicle_type")
        .agg(
            F.sum("amount").alias("type_total_revenue"),
            F.sum("n").alias("type_total_transactions"),
            _mean_amount().alias("average_transaction_amount_by_type"),
            F.max("max_amount").alias("max_transaction_amount_by_type"),
            F.min("min_amount").alias("min_transaction_amount_by_type"),
            _mean_hours().alias("avg_rental_duration_by_type"),
        )
    )
