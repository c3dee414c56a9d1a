"""Column names and types of the datasets, and the file contracts."""

from __future__ import annotations

import re

from pyspark.sql.types import StructType

_LONG_NAMES = {"int": "integer", "bigint": "long", "tinyint": "byte"}


def columns(listed: str) -> StructType:
    """Struct type of a ``name type, ...`` list; needs no running session."""
    schema = StructType()
    for column in re.split(r",\s*(?![^(]*\))", listed):
        name, kind = column.split()
        schema.add(name, _LONG_NAMES.get(kind, kind))
    return schema


# Names, order and types of the datasets' columns.
SONGS = columns(
    "id int, track_id string, artists string, album_name string, track_name string, popularity int, "
    "duration_ms int, explicit boolean, danceability double, energy double, key int, loudness double, "
    "mode int, speechiness double, acousticness double, instrumentalness double, liveness double, "
    "valence double, tempo double, time_signature int, track_genre string"
)
STREAMS = columns("user_id string, track_id string, listen_time string")
LISTENERS = columns(
    "user_id string, user_name string, user_age int, user_country string, created_at string"
)

RENTAL_TRANSACTIONS = columns(
    "user_id string, vehicle_id string, pickup_location int, rental_start_time timestamp, "
    "rental_end_time timestamp, total_amount double"
)
RENTAL_USERS = columns("user_id string")
VEHICLES = columns("vehicle_id string, vehicle_type string")
LOCATIONS = columns(
    "location_id int, location_name string, address string, city string, state string, "
    "zip_code string, latitude double, longitude double"
)

COMMERCE_ORDERS = columns(
    "order_id bigint, user_id bigint, status string, created_at string, num_of_item bigint"
)
COMMERCE_ORDER_ITEMS = columns(
    "id bigint, order_id bigint, user_id bigint, product_id bigint, created_at string, "
    "sale_price double, status string"
)
COMMERCE_PRODUCTS = columns(
    "id bigint, sku string, cost double, category string, name string, retail_price double, department string"
)

GROCERY_ORDERS = columns(
    "order_num int, order_id int, user_id int, order_timestamp timestamp, total_amount double, date date"
)
GROCERY_ORDER_ITEMS = columns("order_id int, id int, order_timestamp timestamp")
GROCERY_PRODUCTS = columns(
    "product_id int, department_id int, department string, product_name string"
)

FLIGHTS = columns(
    "flight_id string, airline string, flight_number int, aircraft_type string, departure_airport string, "
    "arrival_airport string, scheduled_departure_time timestamp, actual_departure_time timestamp, "
    "scheduled_arrival_time timestamp, actual_arrival_time timestamp, gate string, terminal string, "
    "created_at timestamp"
)
FLIGHT_LOGISTICS = columns(
    "flight_id string, fuel_usage decimal(15,8), maintenance_check tinyint, baggage_errors tinyint, "
    "safety_incidents tinyint"
)
PASSENGER_EXPERIENCE = columns(
    "flight_id string, passenger_count int, seat_occupancy decimal(3,2), customer_satisfaction tinyint, "
    "catering_score tinyint, entertainment_score tinyint, cabin_crew_score tinyint"
)

APARTMENTS = columns(
    "id bigint, title string, source string, price decimal(10,2), currency string, "
    "listing_created_on timestamp, is_active boolean, last_modified_timestamp timestamp"
)
APARTMENT_ATTRIBUTES = columns(
    "id bigint, category string, body string, amenities string, bathrooms decimal(3,1), "
    "bedrooms decimal(3,1), fee decimal(10,2), has_photo string, pets_allowed string, "
    "price_display string, price_type string, square_feet int, address string, cityname string, "
    "state string, latitude decimal(10,7), longitude decimal(10,7)"
)
APARTMENT_VIEWINGS = columns(
    "user_id int, apartment_id bigint, viewed_at timestamp, is_wishlisted string, call_to_action string"
)
LOAD_CONFIGURATION = columns(
    "table_name string, load_column string, last_extracted_value string"
)

TRIP_START = columns(
    "trip_id string, pickup_datetime string, estimated_fare_amount decimal(18,2)"
)
TRIP_END = columns(
    "trip_id string, fare_amount decimal(18,2), tip_amount decimal(18,2), total_amount decimal(18,2)"
)

# Every value of a mobile log arrives as a JSON string; numbers are converted
# after parsing.
MOBILE_LOG = columns(
    "hour string, lat string, long string, signal string, network string, operator string, "
    "status string, description string, speed string, satellites string, precission string, "
    "provider string, activity string, postal_code string"
)

CLICKSTREAM_EVENT = columns(
    "id string, user_id string, session_id string, ip_address string, city string, state string, "
    "browser string, traffic_source string, uri string, event_type string"
)
CLICKSTREAM_OUTPUT_ORDER = [
    "id", "user_id", "session_id", "ip_address", "city", "state", "browser", "is_mobile",
    "traffic_source", "traffic_source_category", "uri", "event_type",
]
PURCHASE_HISTORY = columns(
    "user_id string, total_items_purchased int, total_num_orders int, total_amount_spent double"
)

# Columns a song file must have.
REQUIRED_COLUMNS = {
    "songs": SONGS.names,
    "streams": STREAMS.names,
    "users": LISTENERS.names,
}

# Columns and kinds of the commerce files.
FILE_CONTRACTS = {
    "orders": {
        "order_id": "int", "user_id": "int", "status": "text", "created_at": "timestamp",
        "num_of_item": "int",
    },
    "order_items": {
        "id": "int", "order_id": "int", "user_id": "int", "product_id": "int",
        "created_at": "timestamp",
    },
    "products": {
        "id": "int", "sku": "text", "cost": "float", "category": "text", "name": "text",
        "retail_price": "float", "department": "text",
    },
}
