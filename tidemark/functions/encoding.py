"""Base64, JSON, CSV and key text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CSV_LINE_OPTIONS = {
    "quoteAll": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
JSON_OPTIONS = {"allowSingleQuotes": "false"}


def decode_text(data: Column) -> Column:
    """UTF-8 text of base64 data; null where either layer is invalid."""
    return F.try_validate_utf8(F.try_to_binary(data, F.lit("base64")).cast("string"))


def encode_text(text: Column) -> Column:
    return F.base64(F.encode(text, "UTF-8"))


def json_object_fields(text: Column) -> Column:
    """Map of the fields of a JSON object; null for anything else.

    A field that is present but null keeps its key in the map, which tells it
    apart from a field that is missing.
    """
    return F.from_json(text, "map<string,string>", JSON_OPTIONS)


def is_json_object(text: Column) -> Column:
    """Whether the text is one JSON object and nothing else but white space.

    Readers of JSON stop after the first value, so the text is put inside a
    list and inside an object: what follows the value breaks one or the other,
    as no text goes on well after both, or makes the list longer than one.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    nested = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    fields = F.try_variant_get(listed, "$[0]", "map<string,variant>")
    return F.coalesce(
        fields.isNotNull() & nested.isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull(), F.lit(False))


def csv_line(*cols) -> Column:
    """One CSV line with every field in quotes, ending in a line feed."""
    return F.concat(F.to_csv(F.struct(*cols), CSV_LINE_OPTIONS), F.lit("\n"))


def compound_key(*cols) -> Column:
    return F.concat_ws("-", *cols)
