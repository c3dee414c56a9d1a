"""Order KPIs by day, and by day and product category.

``orders``: order_id (unique), user_id, status, created_at, num_of_item.
``items``: order_id, product_id, sale_price. ``products``: id, category.

Items meet their order in one shuffle on order_id and are collapsed to one row
per order right there, with no further exchange; distinct orders are then
plain counts. Adaptive skew handling splits an order that is far too large.
Revenue multiplies each price by the item count of the whole order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import quotient
from ..functions.times import parse_timestamp, strip_utc

RETURNED = "Returned"


def order_timestamp(created_at: Column) -> Column:
    """Order time of a text such as ``2024-01-01 10:00:00 UTC``; null if unreadable."""
    return parse_timestamp(strip_utc(created_at))


def _order_items(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    dated = orders.select(
        "order_id",
        F.col("user_id").alias("user_id_order"),
        (F.col("status") == RETURNED).alias("returned"),
        F.to_date(order_timestamp(F.col("created_at"))).alias("order_date"),
        "num_of_item",
    ).filter(F.col("order_date").isNotNull())
    priced = items.select("order_id", "product_id", "sale_price").join(
        products.select(F.col("id").alias("product_id"), "category"), "product_id"
    )
    return priced.join(dated, "order_id")


def category_wise_summary(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    per_order = (
        _order_items(orders, items, products)
        .filter(F.col("category").isNotNull())
        .groupBy("order_id", "order_date", "category", "num_of_item")
        .agg(
            F.sum("sale_price").alias("price"),
            F.count("sale_price").alias("prices"),
            F.max("returned").alias("returned"),
        )
    )
    return per_order.groupBy("order_date", "category").agg(
        F.sum(F.col("price") * F.col("num_of_item")).alias("daily_revenue"),
        quotient(F.sum("price"), F.sum("prices")).alias("avg_order_value"),
        quotient(F.count_if("returned"), F.count("*")).alias("avg_return_rate"),
    )


def daily_order_summary(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    per_order = (
        _order_items(orders, items, products)
        .groupBy("order_id", "order_date", "user_id_order", "num_of_item")
        .agg(
            F.sum("sale_price").alias("price"),
            F.count("*").alias("lines"),
            F.max("returned").alias("returned"),
        )
    )
    return per_order.groupBy("order_date").agg(
        F.count("*").alias("total_orders"),
        F.sum(F.col("price") * F.col("num_of_item")).alias("total_revenue"),
        F.sum(F.col("lines") * F.col("num_of_item")).alias("total_items_sold"),
        quotient(F.count_if("returned"), F.count("*")).alias("return_rate"),
        F.count_distinct("user_id_order").alias("unique_customers"),
    )
