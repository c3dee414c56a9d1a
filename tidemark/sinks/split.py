"""Two outputs from one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_ok_failed(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the condition, and all others (null counts as failed)."""
    passed = F.coalesce(ok, F.lit(False))
    return df.filter(passed), df.filter(~passed)
