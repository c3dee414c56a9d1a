"""Listening metrics in half-hour windows over a stream of plays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import parse_timestamp
from ..operators.joins import join_static

# The window, and the names of the result's columns below.
WINDOW = "30 minutes"
LATENESS = "10 minutes"


def with_listen_time(events: DataFrame) -> DataFrame:
    """Listen time from its text form; text that does not fit gives null."""
    return events.withColumn("timestamp", parse_timestamp(F.col("listen_time")))


def music_metrics(events: DataFrame, songs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Listens, approximate users and mean duration per window and track.

    ``events``: user_id, track_id, timestamp. Rows are joined with the static
    catalogue as they come and counted once the window has closed. ``history``
    are earlier plays; they tell the tracks that a large catalogue is salted for.
    """
    catalogue = songs.select("track_id", "artists", "album_name", "duration_ms")
    joined = join_static(events.withWatermark("timestamp", LATENESS), catalogue, ["track_id"], history=history)
    return (
        joined.groupBy(F.window("timestamp", WINDOW), "track_id", "artists", "album_name")
        .agg(
            F.count("user_id").alias("total_listens"),
            F.approx_count_distinct("user_id").alias("unique_users"),
            F.avg("duration_ms").alias("average_listen_duration"),
        )
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            "track_id", "artists", "album_name", "total_listens", "unique_users", "average_listen_duration",
        )
    )
