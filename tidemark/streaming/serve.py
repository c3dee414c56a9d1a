"""The newest windows of each mobile metric, rounded for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .mobile import read_metric

NEWEST = 10
HOUR_MICROS = 3_600_000_000
HOURS_OF_DAY = 24


def read_recent(spark: SparkSession, path: str, name: str, n: int = NEWEST) -> DataFrame:
    """Written windows of a metric from a time on that leaves ``n`` or more.

    The newest and oldest start come from a scan of that column. What is read
    in full lies in the hour folders of the last hour, and in files whose
    times reach into it; the span grows sixfold until it holds enough.
    """
    windows = read_metric(spark, path, name)
    start = F.unix_micros("window_start")
    oldest, newest = windows.agg(F.min(start), F.max(start)).first()
    hours = 1
    while newest is not None and newest - hours * HOUR_MICROS >= oldest:
        recent = windows.filter(F.col("window_start") > F.timestamp_micros(F.lit(newest - hours * HOUR_MICROS)))
        if hours < HOURS_OF_DAY:
            last = newest // HOUR_MICROS
            recent = recent.filter(F.col("partition_hour").isin(
                [f"{(last - back) % HOURS_OF_DAY:02d}" for back in range(hours + 1)]))
        if recent.limit(n).count() == n:
            return recent
        hours *= 6
    return windows


def _newest(df: DataFrame, columns: list, n: int) -> DataFrame:
    """Top n by window start. The other columns settle ties, so the rows are
    the same in every run; each task keeps n rows only."""
    order: list[Column] = [F.col("window_start").cast("timestamp").desc()]
    picked = df.select(*columns)
    return picked.orderBy(*order, *[F.col(c) for c in picked.columns if c != "window_start"]).limit(n)


def latest_gps_precision(windows: DataFrame, n: int = NEWEST) -> DataFrame:
    return _newest(windows, [
        "provider", F.round("average_precision", 2).alias("average_precision"),
        F.round("average_satellites", 2).alias("average_satellites"),
        "partition_hour", "window_start", "window_end",
    ], n)


def latest_signal_strength(windows: DataFrame, n: int = NEWEST) -> DataFrame:
    return _newest(windows, [
        "operator", F.round("average_signal", 0).alias("average_signal"),
        "partition_hour", "postal_code", "window_start", "window_end",
    ], n)


def latest_status_count(windows: DataFrame, n: int = NEWEST) -> DataFrame:
    return _newest(
        windows, ["status", "status_count", "partition_hour", "postal_code", "window_start", "window_end"], n
    )
