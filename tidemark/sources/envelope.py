"""Records that carry a JSON object as base64 text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.encoding import JSON_OPTIONS, decode_text, is_json_object, json_object_fields

REJECTED = "__rejected"


def parse_envelope(
    df: DataFrame, schema: StructType, data_col: str = "data", not_null: list[str] = ()
) -> DataFrame:
    """Add ``payload``, which holds the fields, and ``valid`` to every record.

    A record is valid when its data decodes to a JSON object and no field of
    ``not_null`` is given as null; a field that is missing is allowed.
    """
    text = decode_text(F.col(data_col))
    # Anything but an object ends up in the extra field.
    wide = StructType([*schema, StructField(REJECTED, StringType())])
    payload = F.from_json(text, wide, JSON_OPTIONS | {"columnNameOfCorruptRecord": REJECTED})
    parsed = df.withColumn("payload", payload)
    # One pair of braces around the text cannot hold a second object; only other
    # texts are parsed again.
    ends = F.btrim(text, F.lit(" \t\r\n"))
    braces = F.length(text) - F.length(F.translate(text, "{}", ""))
    flat = ends.startswith("{") & ends.endswith("}") & (braces == 2)
    single = F.when(flat, F.lit(True)).otherwise(is_json_object(text))
    valid: Column = F.col("payload").isNotNull() & F.col(f"payload.{REJECTED}").isNull() & single
    for name in not_null:
        # The text is looked at again only where the field has no value.
        unnamed = F.when(
            F.col(f"payload.{name}").isNull(), ~F.map_contains_key(json_object_fields(text), F.lit(name))
        ).otherwise(F.lit(True))
        valid = valid & unnamed
    return parsed.withColumn("valid", F.coalesce(valid, F.lit(False)))


def decode_envelope(
    df: DataFrame, schema: StructType, data_col: str = "data", not_null: list[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Split records into decoded ones and failed ones, which stay as received."""
    parsed = parse_envelope(df, schema, data_col, not_null)
    others = [c for c in df.columns if c != data_col]
    ok = parsed.filter("valid").select(*others, *[f"payload.{name}" for name in schema.names])
    failed = parsed.filter("NOT valid").select(*df.columns)
    return ok, failed
