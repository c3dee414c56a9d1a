"""Lake tables kept up to date from landing files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.tables import KeyedTable, create_or_upsert, with_date


# Folders of a table without dates; ``KeyedTable.rebucket`` raises it as a table grows.
BUCKETS = 16


@dataclass(frozen=True)
class LakeTable:
    keys: list[str]
    ts_col: str | None = None
    date_col: str | None = None

    @property
    def buckets(self) -> int | None:
        return None if self.date_col else BUCKETS


# Key columns and partition date of each table.
LAKE_TABLES = {
    "flights": LakeTable(["flight_id"], "created_at", "flight_date"),
    "flight_logistics": LakeTable(["flight_id"]),
    "passenger_experience": LakeTable(["flight_id"]),
    "orders": LakeTable(["order_id"], "order_timestamp", "order_date"),
    "order_items": LakeTable(["order_id", "id"], "order_timestamp", "order_date"),
    "products": LakeTable(["product_id"]),
}


def upsert_lake_table(table: KeyedTable, df: DataFrame, layout: LakeTable, **options) -> KeyedTable:
    """Create the table, by date or by buckets of its keys, or merge the rows into it."""
    rows = with_date(df, layout.ts_col, layout.date_col) if layout.ts_col else df
    return create_or_upsert(table, rows, layout.keys, layout.date_col, layout.buckets, **options)
