"""Clickstream records enriched with device and traffic category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import csv_line, encode_text
from ..functions.labels import is_mobile_browser, traffic_source_category, yes_no
from ..schemas import CLICKSTREAM_EVENT, CLICKSTREAM_OUTPUT_ORDER
from ..sinks.split import split_ok_failed
from ..sources.envelope import parse_envelope

OK = "Ok"
FAILED = "ProcessingFailed"


def _enriched(records: DataFrame) -> DataFrame:
    """Fields filled with '' where missing, plus the two derived ones."""
    parsed = parse_envelope(records, CLICKSTREAM_EVENT, not_null=["browser", "traffic_source"])
    fields = [F.coalesce(f"payload.{n}", F.lit("")).alias(n) for n in CLICKSTREAM_EVENT.names]
    filled = parsed.select(*records.columns, "valid", *fields)
    return (
        filled.withColumn("is_mobile", yes_no(is_mobile_browser(F.col("browser"))))
        .withColumn("traffic_source_category", traffic_source_category(F.col("traffic_source")))
    )


def enrich_clickstream(records: DataFrame) -> DataFrame:
    """The twelve output columns of every record that can be processed."""
    return _enriched(records).filter("valid").select(*CLICKSTREAM_OUTPUT_ORDER)


def transform_records(records: DataFrame) -> DataFrame:
    """One row per record: id, status and base64 data.

    Data is the enriched CSV line, or the original payload of a failed record.
    Works on a batch and on a stream.
    """
    line = encode_text(csv_line(*CLICKSTREAM_OUTPUT_ORDER))
    return _enriched(records).select(
        "recordId",
        F.when(F.col("valid"), F.lit(OK)).otherwise(F.lit(FAILED)).alias("result"),
        F.when(F.col("valid"), line).otherwise(F.col("data")).alias("data"),
    )


def route_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transformed records for the table, and failed ones for the dead-letter path."""
    return split_ok_failed(transform_records(records), F.col("result") == OK)
