"""Listener counts that add up, over hours, days and months and over batches.

A number of distinct users cannot be added to another. What can be is kept in
its place: bitmaps, exact, where users are whole numbers; sketches, within a
few percent, where they are texts or too scattered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.tables import KeyedTable

HOUR = ["listen_date", "listen_hour", "bucket"]
SONG_DAY = ["track_id", "report_date"]


# -- exact, by bitmap ---------------------------------------------------------

def listener_bitmaps(streams: DataFrame) -> DataFrame:
    """Who listened in each hour, 32,768 ids to a row of 4 KiB.

    Ids must be whole numbers, and close to each other for rows to be few.
    Plays without a user or a time are left out.
    """
    user = F.col("user_id").cast("bigint")
    heard = streams.select(
        F.to_date("listen_time").alias("listen_date"), F.hour("listen_time").alias("listen_hour"),
        F.bitmap_bucket_number(user).alias("bucket"), F.bitmap_bit_position(user).alias("position"),
    )
    return (
        heard.filter(F.col("listen_date").isNotNull() & F.col("bucket").isNotNull())
        .groupBy(*HOUR).agg(F.bitmap_construct_agg("position").alias("users"))
    )


def add_bitmaps(*batches: DataFrame) -> DataFrame:
    """Bitmaps of several batches as those of their union. A batch added twice changes nothing."""
    return reduce(DataFrame.unionByName, batches).groupBy(*HOUR).agg(F.bitmap_or_agg("users").alias("users"))


def unique_listeners(bitmaps: DataFrame, **period: Column) -> DataFrame:
    """Exact distinct users of each period, given as named columns of date and hour."""
    named = [c.alias(n) for n, c in period.items()]
    per_bucket = bitmaps.groupBy(*named, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("users")).alias("n"))
    return per_bucket.groupBy(*period).agg(F.sum("n").alias("unique_listeners"))


# -- approximate, by sketch ---------------------------------------------------

def song_days(streams: DataFrame) -> DataFrame:
    """Sums and a sketch of the users per track and day, from which the song report can be made."""
    plays = streams.filter(F.col("track_id").isNotNull())
    epoch = F.unix_timestamp("listen_time")
    return plays.groupBy("track_id", F.to_date("listen_time").alias("report_date")).agg(
        F.count("*").alias("total_listens"), F.sum(epoch).alias("total_listening_time"),
        F.count(epoch).alias("timed"), F.hll_sketch_agg("user_id").alias("users"),
    )


def add_song_days(held: DataFrame, new: DataFrame, keys: list[str] = SONG_DAY) -> DataFrame:
    """Both frames as if their plays had come together."""
    return held.unionByName(new).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("total_listens", "total_listening_time", "timed")],
        F.hll_union_agg("users").alias("users"),
    )


def keep_song_days(
    table: KeyedTable, streams: DataFrame, feed: str, batch: int, buckets: int | None = None
) -> KeyedTable:
    """Add a batch of plays to the stored days. A batch that is in already is
    not added again. The table is kept by day, of which a batch rewrites those
    it touches, or in buckets where days are many and small."""
    days = song_days(streams)
    if not table.exists():
        table.create(days.limit(0), None if buckets else "report_date", buckets, SONG_DAY)
    return table.upsert(days, SONG_DAY, merge=add_song_days, feed=feed, batch=batch)


def with_user_estimate(days: DataFrame) -> DataFrame:
    return days.withColumn("unique_users", F.hll_sketch_estimate("users")).drop("users")
