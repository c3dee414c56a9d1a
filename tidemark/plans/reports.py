"""Report tables that the KPIs are upserted into."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import to_money, to_ratio
from ..operators.merge import merge_all, patch_items, replace_by_key
from ..operators.staging import staged
from ..operators.tables import KeyedTable

# Keys of the report tables.
REPORT_KEYS = {
    "genre_level_kpis": ["listen_date", "track_genre"],
    "hourly_kpis": ["listen_date", "listen_hour"],
    "track_level_reports": ["track_id", "report_date"],
    "category_wise_summary": ["category", "order_date"],
    "daily_order_summary": ["order_date"],
}
TRACK_FIELDS = ["total_listens", "unique_users", "total_listening_time", "avg_listening_time_per_user"]


def track_report_rows(top_songs: DataFrame) -> DataFrame:
    """One patch per track and day; a track listed under several genres has the
    same figures under each."""
    return (
        top_songs.select(*REPORT_KEYS["track_level_reports"], *TRACK_FIELDS)
        .withColumn("avg_listening_time_per_user", to_ratio(F.col("avg_listening_time_per_user")))
        .distinct()
    )


def patch_track_reports(target: DataFrame, top_songs: DataFrame) -> DataFrame:
    """Set the four figures; other attributes of the report stay. The merge reads
    the figures several times, so they are worked out once."""
    rows = staged(track_report_rows(top_songs), "track-reports")
    return patch_items(target, rows, REPORT_KEYS["track_level_reports"])


def category_report_rows(summary: DataFrame) -> DataFrame:
    return summary.select(
        "category", F.col("order_date").cast("string").alias("order_date"),
        to_money(F.col("daily_revenue")).alias("daily_revenue"),
        to_ratio(F.col("avg_order_value")).alias("avg_order_value"),
        to_ratio(F.col("avg_return_rate")).alias("avg_return_rate"),
    )


def order_report_rows(summary: DataFrame) -> DataFrame:
    return summary.select(
        F.col("order_date").cast("string").alias("order_date"), "total_orders",
        to_money(F.col("total_revenue")).alias("total_revenue"), "total_items_sold",
        to_ratio(F.col("return_rate")).alias("return_rate"), "unique_customers",
    )


def put_report(target: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """Replace whole rows by key."""
    return merge_all(target, rows, REPORT_KEYS[name])


def replace_report(target: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """Delete rows with the same key, then insert."""
    return replace_by_key(target, rows, REPORT_KEYS[name])


def publish_report(table: KeyedTable, rows: DataFrame, name: str) -> KeyedTable:
    """Keep a report table: create it, or replace the rows the KPIs bring."""
    if not table.exists():
        return table.create(rows)
    return table.upsert(staged(rows, name), REPORT_KEYS[name], merge=replace_by_key)
