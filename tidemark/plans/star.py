"""Rental apartments: raw tables, dimensions and the fact table of viewings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import flag_to_boolean
from ..operators.ids import assign_ids, next_id
from ..operators.merge import merge_columns, one_row_per_key, unmatched
from ..operators.watermark import rows_since_target

# Columns the merges write, in table order.
APARTMENT_COLUMNS = ["title", "source", "price", "currency", "listing_created_on", "is_active"]
ATTRIBUTE_COLUMNS = [
    "category", "body", "amenities", "bathrooms", "bedrooms", "fee", "has_photo", "pets_allowed",
    "price_display", "price_type", "square_feet", "address", "cityname", "state", "latitude", "longitude",
]
VIEWING_COLUMNS = ["is_wishlisted", "call_to_action"]
VIEWING_KEY = ["apartment_id", "user_id", "viewed_at"]
DIM_APARTMENT_COLUMNS = [
    "title", "category", "body", "amenities", "bedrooms", "bathrooms", "square_feet", "address",
    "cityname", "state", "latitude", "longitude", "has_photo", "pets_allowed", "price_display", "price_type",
]
FACT_COLUMNS = ["user_id", "is_wishlisted", "call_to_action", "price", "fee", "currency"]
FACT_ID = "viewing_id"


def merge_raw_apartments(target: DataFrame, staged: DataFrame, loaded_at: Column, **options) -> DataFrame:
    """Staged apartments; the load time is stamped on every row written."""
    return merge_columns(
        target, staged, ["id"], APARTMENT_COLUMNS, APARTMENT_COLUMNS,
        stamp={"last_modified_timestamp": loaded_at}, **options,
    )


def merge_raw_attributes(target: DataFrame, staged: DataFrame, **options) -> DataFrame:
    return merge_columns(target, staged, ["id"], ATTRIBUTE_COLUMNS, ATTRIBUTE_COLUMNS, **options)


def merge_raw_viewings(target: DataFrame, staged: DataFrame, **options) -> DataFrame:
    return merge_columns(target, staged, VIEWING_KEY, VIEWING_COLUMNS, VIEWING_COLUMNS, **options)


def stage_dim_apartments(apartments: DataFrame, attributes: DataFrame) -> DataFrame:
    described = attributes.select("id", *[c for c in DIM_APARTMENT_COLUMNS if c != "title"])
    return apartments.select("id", "title").join(described, "id").select(
        F.col("id").alias("apartment_id"), *DIM_APARTMENT_COLUMNS
    )


def merge_dim_apartments(dim: DataFrame, apartments: DataFrame, attributes: DataFrame, **options) -> DataFrame:
    staged = stage_dim_apartments(apartments, attributes)
    return merge_columns(dim, staged, ["apartment_id"], DIM_APARTMENT_COLUMNS, DIM_APARTMENT_COLUMNS, **options)


def merge_dim_users(dim: DataFrame, viewings: DataFrame) -> DataFrame:
    """Users seen in the viewings; a known user has nothing to update."""
    return merge_columns(dim, viewings.select("user_id").distinct(), ["user_id"], [], ["user_id"])


def stage_fact_viewings(viewings: DataFrame, apartments: DataFrame, attributes: DataFrame, fact: DataFrame) -> DataFrame:
    """Viewings at or after the newest one in the fact table, with their prices."""
    recent = rows_since_target(viewings, "viewed_at", fact)
    priced = apartments.select(F.col("id").alias("apartment_id"), "price", "currency")
    fees = attributes.select(F.col("id").alias("apartment_id"), "fee")
    return (
        recent.withColumn("is_wishlisted", flag_to_boolean(F.col("is_wishlisted")))
        .join(priced, "apartment_id").join(fees, "apartment_id")
        .select(*VIEWING_KEY, "is_wishlisted", "call_to_action", "price", "fee", "currency")
    )


def merge_fact_viewings(
    fact: DataFrame, staged: DataFrame, keys: list[str] = VIEWING_KEY, **options
) -> DataFrame:
    """Update known viewings, which keep their id; number and insert the others."""
    columns = [c for c in FACT_COLUMNS if c not in keys]
    known = merge_columns(fact, staged, keys, columns, None, **options)
    fresh = unmatched(one_row_per_key(staged, keys, **options), fact, keys)
    numbered = assign_ids(fresh, FACT_ID, ["viewed_at", "apartment_id", "user_id"], next_id(fact, FACT_ID))
    return known.unionByName(numbered.select(*fact.columns))
