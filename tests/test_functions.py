from __future__ import annotations

import base64
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import aggregates, encoding, labels, numbers, times
from tidemark.plans import clickstream
from tidemark.schemas import CLICKSTREAM_EVENT, columns
from tidemark.sources.envelope import decode_envelope

PHONE = "Roamer/7.2 (iPhone; model Q4) TideEngine/11"
DESKTOP = "Roamer/7.2 (desk machine; 64 bit) TideEngine/11"


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()[0]


@pytest.mark.parametrize("age,band", [
    (0, None), (1, "18-25"), (25, "18-25"), (26, "26-35"), (35, "26-35"), (65, "56-65"), (66, "66+"),
    (100, "66+"), (101, None), (None, None),
])
def test_age_bands_include_their_upper_bound(spark, age, band):
    assert one(spark, labels.age_band(F.lit(age).cast("int"))) == band


def test_mobile_browsers(spark):
    assert one(spark, labels.is_mobile_browser(F.lit(PHONE))) is True
    assert one(spark, labels.is_mobile_browser(F.lit(DESKTOP))) is False
    assert one(spark, labels.is_mobile_browser(F.lit("android"))) is False


@pytest.mark.parametrize("source,category", [
    ("Google", "Search Engine"), ("Bing", "Search Engine"), ("Facebook", "Social Media"),
    ("Email Newsletter", "Email"), ("Direct Access", "Direct"), ("Email via Facebook", "Social Media"),
    ("YouTube on Google", "Search Engine"), ("", "Direct"),
])
def test_traffic_categories_in_order(spark, source, category):
    assert one(spark, labels.traffic_source_category(F.lit(source))) == category


def test_unreadable_times_are_null(spark):
    assert one(spark, times.parse_timestamp(F.lit("2024-13-01 00:00:00"))) is None
    assert str(one(spark, times.parse_timestamp(times.strip_utc(F.lit("2024-01-02 03:04:05 UTC"))))) == "2024-01-02 03:04:05"
    assert str(one(spark, times.clock_time_on("2023-01-01", F.lit("23:59:59")))) == "2023-01-01 23:59:59"


def test_spending_compares_whole_amounts(spark):
    above = [one(spark, numbers.whole_part_above(F.lit(v), 100)) for v in (100.0, 100.99, 101.0)]
    assert above == [False, False, True]


def test_decimals_round_half_up_or_give_null(spark):
    assert str(one(spark, numbers.to_money(F.lit("1.005")))) == "1.01"
    assert one(spark, numbers.to_money(F.lit("abc"))) is None
    assert one(spark, numbers.lenient_double(F.lit("abc"))) is None


def test_invalid_layers_decode_to_null(spark):
    bad_utf8 = base64.b64encode(b"\xff\xfe{").decode()
    for text in ("!!", bad_utf8):
        assert one(spark, encoding.decode_text(F.lit(text))) is None


def test_csv_line_keeps_blanks_quotes_and_empty_fields(spark):
    line = one(spark, encoding.csv_line(F.lit(' a "b" ').alias("x"), F.lit("").alias("y")))
    assert line == '" a ""b"" ",""\n'


def test_quotient_of_nothing_is_null(spark):
    assert one(spark, aggregates.quotient(F.lit(1), F.lit(0))) is None


# -- envelopes ---------------------------------------------------------------

def pack(text: str | bytes) -> str:
    return base64.b64encode(text if isinstance(text, bytes) else text.encode()).decode()


def test_envelopes_that_are_no_json_object_fail_alone(spark):
    payloads = {
        "good": pack('{"a": "1", "b": "x"}'), "missing": pack('{"b": "x"}'), "null": pack('{"a": null}'),
        "array": pack('[{"a": "1"}]'), "scalar": pack("5"), "nothing": pack(""), "json null": pack("null"),
        "broken": pack('{"a": '), "trailing": pack('{"a": "1"} more'), "single quotes": pack("{'a': '1'}"),
        "twice": pack('{"a": "1", "a": "2"}'), "nested": pack('{"a": "1", "c": {"d": [1]}}'),
        "no base64": "%%%", "none": None, "number": pack('{"a": 7}'),
    }
    df = spark.createDataFrame(list(payloads.items()), "id string, data string")
    ok, failed = decode_envelope(df, columns("a string, b string"), not_null=["a"])
    assert {r["id"]: r["a"] for r in ok.collect()} == {"good": "1", "missing": None, "number": "7", "twice": "2", "nested": "1"}
    assert {r["id"]: r["data"] for r in failed.collect()} == {
        k: v for k, v in payloads.items() if k not in ("good", "missing", "number", "twice", "nested")
    }


EVENT = {
    "id": "e-7", "user_id": "u-41", "session_id": "s/9", "ip_address": "10.20.30.40",
    "city": "Port Ellen", "state": "ZZ", "browser": PHONE, "traffic_source": "Bing", "uri": "/shelf/3",
    "event_type": "scroll",
}


def transformed(spark, *payloads):
    df = spark.createDataFrame([(str(i), p) for i, p in enumerate(payloads)], "recordId string, data string")
    return [tuple(r) for r in clickstream.transform_records(df).orderBy("recordId").collect()]


def test_clickstream_record_becomes_a_quoted_line(spark):
    (record,) = transformed(spark, pack(json.dumps(EVENT)))
    assert record[:2] == ("0", "Ok")
    assert base64.b64decode(record[2]).decode() == (
        f'"e-7","u-41","s/9","10.20.30.40","Port Ellen","ZZ","{PHONE}","Yes","Bing",'
        '"Search Engine","/shelf/3","scroll"\n'
    )


def test_failed_clickstream_record_keeps_its_data(spark):
    bad = pack("not an object")
    null_browser = pack(json.dumps(EVENT | {"browser": None}))
    null_city = pack(json.dumps(EVENT | {"city": None}))
    out = transformed(spark, bad, null_browser, null_city, pack("{}"))
    assert out[0] == ("0", "ProcessingFailed", bad)
    assert out[1] == ("1", "ProcessingFailed", null_browser)
    assert out[2][1] == "Ok" and '"10.20.30.40","","ZZ"' in base64.b64decode(out[2][2]).decode()
    assert base64.b64decode(out[3][2]).decode() == '"","","","","","","","No","","Direct","",""\n'


def test_route_keeps_every_record_once(spark):
    df = spark.createDataFrame([("a", pack(json.dumps(EVENT))), ("b", "??")], "recordId string, data string")
    ok, failed = clickstream.route_records(df)
    assert [r[0] for r in ok.collect()] == ["a"] and [r[0] for r in failed.collect()] == ["b"]
    assert len(CLICKSTREAM_EVENT.names) == 10


@pytest.mark.parametrize("text, valid", [
    ('{"id":"1"}\n', True), ('\t{"id":"1"}\t\r\n ', True), ('{"id":"1"}{"id":"2"}', False), ('{"id":"1"},{"id":"2"}', False),
    ('{"id":"1"} x', False), ('[{"id":"1"}]', False), ('"{}"', False), ("", False), ("null", False), ('{"id":"1"', False),
    ('{"id":"1"}]', False)])
def test_an_envelope_holds_one_object(spark, text, valid):
    from tidemark.schemas import columns
    from tidemark.sources.envelope import parse_envelope

    df = spark.createDataFrame([(text,)], "text string").select(F.base64(F.col("text").cast("binary")).alias("data"))
    assert parse_envelope(df, columns("id string")).first()["valid"] is valid
