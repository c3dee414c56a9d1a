"""High-water marks and the extracts that depend on them."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import KeyedTable

FIRST_MARK = "1970-01-01 00:00:00"
STATE_KEY = ["table_name"]
# The first state of the mark store.
SEED = [
    ("apartments", "last_modified_timestamp", None),
    ("apartment_attributes", None, None),
    ("apartment_viewings", "viewed_at", None),
]


def extract_full(df: DataFrame) -> DataFrame:
    return df


def extract_incremental(df: DataFrame, col: str, last) -> DataFrame:
    """Rows after the last mark; all rows when there is no mark yet."""
    if last is None:
        return extract_full(df)
    return df.filter(F.col(col) > F.lit(last).cast(df.schema[col].dataType))


def extract_date_slice(df: DataFrame, col: str, day: date | None = None) -> DataFrame:
    """Rows of one day, by default today in UTC, as a range the source can use."""
    day = day or datetime.now(timezone.utc).date()
    kind = df.schema[col].dataType
    low, high = (F.lit(str(d)).cast(kind) for d in (day, day + timedelta(days=1)))
    return df.filter((F.col(col) >= low) & (F.col(col) < high))


def seed_marks(store: KeyedTable, rows: list[tuple] = SEED) -> KeyedTable:
    return store.create(
        store.spark.createDataFrame(rows, "table_name string, load_column string, last_extracted_value string")
    )


def get_hwm(store: KeyedTable, table: str) -> tuple[str, str | None]:
    """Load column and last mark of a table."""
    row = store.read().filter(F.col("table_name") == table).first()
    if row is None or row["load_column"] is None:
        raise LookupError(f"no load column configured for {table}")
    return row["load_column"], row["last_extracted_value"]


def mark_of(extract: DataFrame, col: str) -> str | None:
    """The largest value extracted, as text; null for an empty extract."""
    return extract.agg(F.max(col).cast("string")).first()[0]


def advance_hwm(store: KeyedTable, table: str, value: str | None) -> str | None:
    """Move the mark of a table; no value, as of an empty extract, leaves it."""
    column, last = get_hwm(store, table)
    if value is None:
        return last
    row = store.spark.createDataFrame(
        [(table, column, value)], "table_name string, load_column string, last_extracted_value string"
    )
    store.upsert(row, STATE_KEY)
    return value


def target_watermark(target: DataFrame, col: str) -> DataFrame:
    """One row: the largest value in the target, or the first mark."""
    kind = target.schema[col].dataType
    return target.agg(F.coalesce(F.max(col), F.lit(FIRST_MARK).cast(kind)).alias("watermark"))


def rows_since_target(df: DataFrame, col: str, target: DataFrame, target_col: str | None = None) -> DataFrame:
    """Rows at or after the target's mark. The mark is one value and is read
    first, so that it reaches the source as a constant."""
    mark = target_watermark(target, target_col or col).first()[0]
    return df.filter(F.col(col) >= F.lit(mark).cast(df.schema[col].dataType))
