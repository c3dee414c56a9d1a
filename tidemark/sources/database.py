"""Extracts from a database over JDBC.

The frames are lazy: a filter put on them by the extract functions in
``operators.watermark`` becomes part of the query the database runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def split_options(column: str | None, lower, upper, partitions: int | None) -> dict[str, str]:
    """Options for a parallel read; all four parts of a split go together."""
    parts = (column, lower, upper, partitions)
    if all(p is None for p in parts):
        return {}
    if any(p is None for p in parts):
        raise ValueError("a split read needs column, lower, upper and partitions")
    return {
        "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_table(
    spark: SparkSession, url: str, table: str, column: str | None = None, lower=None, upper=None,
    partitions: int | None = None, **options,
) -> DataFrame:
    """A whole table, read in ``partitions`` ranges of ``column``.

    Credentials come in through ``options`` and are not kept here.
    """
    settings = {"url": url, "dbtable": table, "fetchsize": "10000"}
    settings |= split_options(column, lower, upper, partitions) | options
    return spark.read.format("jdbc").options(**settings).load()
