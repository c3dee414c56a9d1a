"""Intermediate results that several later steps read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once under the shared folder and read them from there.

    Later steps do not compute the frame again, read only the columns they
    need, and do not depend on executors that may be lost.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
