"""Streams of JSON events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parse_events(df: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """Typed columns of a JSON column; fields that do not fit give null."""
    parsed = F.from_json(F.col(value_col).cast("string"), schema)
    return df.select(parsed.alias("p")).select("p.*")


def read_event_stream(
    spark: SparkSession, fmt: str, options: dict[str, str], schema: StructType, value_col: str = "value"
) -> DataFrame:
    """Unbounded source by connector name, such as text files or a message log."""
    reader = spark.readStream.format(fmt).options(**options)
    return parse_events(reader.load(), schema, value_col)
