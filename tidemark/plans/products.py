"""Metrics per product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import utc_timestamp
from tidemark.operators.ranking import top


def product_performance(products: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per product that was sold.

    The exact distinct count makes Spark group by (product, customer) first, so
    the orders of one very popular product are spread over many tasks.
    """
    per_product = orders.groupBy("product_id").agg(
        F.count("id").alias("total_orders"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.round(F.avg("quantity"), 2).alias("avg_quantity_per_order"),
        F.min("order_time").alias("first_us"),
        F.max("order_time").alias("last_us"),
    )
    what = products.select(
        F.col("id").alias("product_id"), F.col("name").alias("product_name"), "price"
    )
    return what.join(per_product, "product_id").select(
        "product_id",
        "product_name",
        "price",
        "total_orders",
        "total_quantity_sold",
        "unique_customers",
        "avg_quantity_per_order",
        utc_timestamp(F.col("first_us")).alias("first_sale_date"),
        utc_timestamp(F.col("last_us")).alias("last_sale_date"),
    )


def top_products(performance: DataFrame, n: int = 20) -> DataFrame:
    return top(performance, "total_quantity_sold", "product_id", n).select(
        "product_id",
        "product_name",
        "price",
        "total_orders",
        "total_quantity_sold",
        "unique_customers",
        "last_sale_date",
    )


def top_products_panel(performance: DataFrame, n: int = 10) -> DataFrame:
    return top_products(performance, n).select(
        "product_name", "total_quantity_sold", "total_orders", "unique_customers"
    )
