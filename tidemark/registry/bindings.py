"""The supplied tables in the roles of the flows' datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import to_money
from .core import table

BROWSERS = [
    "Roamer/7.2 (iPhone; model Q4) TideEngine/11",
    "Roamer/7.2 (desk machine; 64 bit) TideEngine/11",
    "Lantern/3 (Android tablet)",
    'Text browser "plain", version 2',
    "Lantern/3 (iPad)",
]
TRAFFIC = {
    "view": "Google Search", "click": "Facebook", "signup": "Email Newsletter",
    "purchase": "YouTube Ads", "error": "Direct Access",
}
PROVIDERS = ["gps", "network", "fused"]


def number_of(spark: SparkSession, sf: str, name: str) -> int:
    """Row count, taken from the file footers."""
    return table(spark, sf, name).count()


# -- listening ---------------------------------------------------------------
def line_streams(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("track_id"),
        F.col("l_shipdate").alias("listen_time"),
    )


def event_streams(spark: SparkSession, sf: str) -> DataFrame:
    parts = number_of(spark, sf, "part")
    return table(spark, sf, "events").select(
        "user_id", (F.col("event_id") % parts).alias("track_id"), F.col("ts").alias("listen_time")
    )


def songs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("track_id"), F.col("p_brand").alias("artists"),
        F.col("p_type").alias("album_name"), F.col("p_name").alias("track_name"),
        (F.col("p_size") * 1000).alias("duration_ms"), F.col("p_type").alias("track_genre"),
    )


def listeners(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), (F.lit(15) + F.col("c_custkey") % 90).alias("user_age")
    )


# -- rental --------------------------------------------------------------------
def order_rentals(spark: SparkSession, sf: str) -> DataFrame:
    ends = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("rental_end_time")
    )
    return table(spark, sf, "orders").join(ends, "o_orderkey", "left").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("rental_start_time"),
        "rental_end_time", to_money(F.col("o_totalprice")).alias("total_amount"),
    )


def renters(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))


def line_rentals(spark: SparkSession, sf: str) -> DataFrame:
    hours = F.make_dt_interval(hours=F.col("l_quantity").cast("int"))
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("pickup_location"), F.col("l_partkey").alias("vehicle_id"),
        F.col("l_shipdate").alias("rental_start_time"),
        (F.col("l_shipdate") + hours).alias("rental_end_time"),
        to_money(F.col("l_extendedprice")).alias("total_amount"),
    )


def rental_locations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("location_id"), F.col("s_name").alias("location_name")
    )


def vehicles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("vehicle_id"), F.col("p_type").alias("vehicle_type")
    )


# -- commerce --------------------------------------------------------------------
def shop_orders(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("num_of_item")
    )
    returned = F.when(F.col("o_orderstatus") == "F", "Returned").otherwise(F.col("o_orderstatus"))
    return table(spark, sf, "orders").join(lines, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        returned.alias("status"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("created_at"),
        F.coalesce("num_of_item", F.lit(0)).cast("int").alias("num_of_item"),
    )


def shop_items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        to_money(F.col("l_extendedprice")).alias("sale_price"),
    )


def shop_products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("category")
    )


# -- trips -------------------------------------------------------------------------
def trip_starts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sequence"), F.col("o_orderkey").cast("string").alias("trip_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"),
        to_money(F.col("o_totalprice")).alias("estimated_fare_amount"),
    )


def known_trip_starts(spark: SparkSession, sf: str) -> DataFrame:
    """Starts of all but urgent orders; the ends of urgent ones find no trip."""
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") != "1-URGENT").select(
        F.col("o_orderkey").alias("sequence")
    )
    return trip_starts(spark, sf).join(urgent, "sequence", "left_semi")


def trip_ends(spark: SparkSession, sf: str) -> DataFrame:
    """One end per order that has lines."""
    return (
        table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("sequence"))
        .agg(
            F.sum(to_money(F.col("l_extendedprice"))).alias("fare_amount"),
            F.sum(to_money(F.col("l_tax"))).alias("tip_amount"),
        )
        .select(
            "sequence", F.col("sequence").cast("string").alias("trip_id"),
            "fare_amount", "tip_amount",
            (F.col("fare_amount") + F.col("tip_amount")).alias("total_amount"),
        )
    )


def enveloped(df: DataFrame, fields: list[str], keep: list[str]) -> DataFrame:
    """Records as a message log hands them over: base64 of a JSON object."""
    return df.select(*keep, F.base64(F.to_json(F.struct(*fields)).cast("binary")).alias("data"))


# -- events --------------------------------------------------------------------------
def cart_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "user_id")


def purchase_history(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.sum(to_money(F.col("o_totalprice"))).alias("total_amount_spent")
    )


def _pick(values: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position % len(values) + 1).cast("int"))


def click_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as clickstream records; some carry damaged or incomplete data."""
    events = table(spark, sf, "events")
    source = F.element_at(F.create_map(*[F.lit(x) for kv in TRAFFIC.items() for x in kv]), F.col("event_type"))
    payload = F.struct(
        F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("s-"), F.col("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.concat(F.lit("10.0.0."), F.col("user_id")).alias("ip_address"),
        # to_json leaves out nulls, so these users' fields are missing.
        F.when(F.col("user_id") != 8, F.lit("New York")).alias("city"), F.lit("NY").alias("state"),
        F.when(F.col("user_id") != 9, _pick(BROWSERS, F.col("user_id"))).alias("browser"),
        source.alias("traffic_source"),
        F.concat(F.lit("/item?v="), F.col("value").cast("decimal(18,2)").cast("string")).alias("uri"),
        "event_type",
    )
    text = F.to_json(payload)
    null_browser = F.regexp_replace(text, '"browser":"[^,]*,', '"browser":null,')
    damaged = F.col("event_type") == "error"
    data = (
        F.when(damaged & (F.col("user_id") % 3 == 0), F.lit("%% no base64 %%"))
        .when(damaged & (F.col("user_id") % 3 == 1), F.base64(F.lit("invalid json data").cast("binary")))
        .when(F.col("user_id") == 11, F.base64(null_browser.cast("binary")))
        .when(F.col("user_id") == 12, F.base64(F.concat(F.lit("["), text, F.lit("]")).cast("binary")))
        .otherwise(F.base64(text.cast("binary")))
    )
    return events.select(F.col("event_id").cast("string").alias("recordId"), data.alias("data"))


def mobile_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as coverage logs; every value is a text."""
    return table(spark, sf, "events").select(
        F.date_format("ts", "HH:mm:ss").alias("hour"),
        F.col("value").cast("string").alias("signal"),
        F.col("event_type").alias("operator"), F.col("event_type").alias("status"),
        F.get_json_object("props", "$.k").alias("satellites"),
        F.col("value").cast("string").alias("precission"),
        _pick(PROVIDERS, F.col("user_id")).alias("provider"),
        (F.col("user_id") % 10).cast("string").alias("postal_code"),
    )


# -- apartments -----------------------------------------------------------------------
def apartments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("source"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"), F.lit("USD").alias("currency"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("listing_created_on"),
        (F.col("p_size") > 10).alias("is_active"),
        F.lit("2024-01-02 00:00:00").cast("timestamp").alias("last_modified_timestamp"),
    )


def apartment_attributes(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("category"),
        F.concat(F.lit("About "), F.col("p_name")).alias("body"), F.lit("Parking,Gym").alias("amenities"),
        (size % 4).cast("decimal(3,1)").alias("bathrooms"), (size % 6).cast("decimal(3,1)").alias("bedrooms"),
        (size * 10).cast("decimal(10,2)").alias("fee"),
        F.when(size > 25, "Yes").otherwise("Thumbnail").alias("has_photo"), F.lit("Cats").alias("pets_allowed"),
        F.concat(F.lit("$"), size.cast("string")).alias("price_display"), F.lit("Monthly").alias("price_type"),
        (size * 100).alias("square_feet"), F.concat(size.cast("string"), F.lit(" Main St")).alias("address"),
        F.col("p_brand").alias("cityname"), F.lit("NY").alias("state"),
        (size / F.lit(2)).cast("decimal(10,7)").alias("latitude"),
        (-size / F.lit(4)).cast("decimal(10,7)").alias("longitude"),
    )


def viewings(spark: SparkSession, sf: str) -> DataFrame:
    parts = number_of(spark, sf, "part")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("int").alias("user_id"), (F.col("event_id") % parts).alias("apartment_id"),
        F.col("ts").cast("timestamp").alias("viewed_at"),
        F.when(F.col("event_type") == "purchase", "Y").otherwise("N").alias("is_wishlisted"),
        F.col("event_type").alias("call_to_action"),
    )
