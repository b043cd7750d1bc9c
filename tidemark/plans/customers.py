"""Metrics per customer and about the customer base."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_of_micros, day_of, utc_timestamp
from tidemark.functions.times import MICROS_PER_DAY, AsOf
from tidemark.operators.ranking import top


def customer_metrics(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer that has orders.

    Orders are reduced to one row per customer before the join: keys are unique
    on both sides by then, so a customer holding most orders is no hot key.
    """
    per_customer = orders.groupBy("customer_id").agg(
        F.count("id").alias("total_orders"),
        F.sum("quantity").alias("total_items_purchased"),
        F.min("order_time").alias("first_us"),
        F.max("order_time").alias("last_us"),
        F.round(F.avg("quantity"), 2).alias("avg_items_per_order"),
    )
    who = customers.select(F.col("id").alias("customer_id"), "name", "email", "created_at")
    return who.join(per_customer, "customer_id").select(
        "customer_id",
        "name",
        "email",
        utc_timestamp(F.col("created_at")).alias("customer_since"),
        "total_orders",
        "total_items_purchased",
        utc_timestamp(F.col("first_us")).alias("first_order_date"),
        utc_timestamp(F.col("last_us")).alias("last_order_date"),
        "avg_items_per_order",
        F.date_diff(day_of(F.col("last_us")), day_of(F.col("first_us"))).alias(
            "customer_lifespan_days"
        ),
    )


def top_customers(metrics: DataFrame, n: int = 50) -> DataFrame:
    return top(metrics, "total_orders", "customer_id", n).select(
        "customer_id", "name", "email", "total_orders", "total_items_purchased", "last_order_date"
    )


def top_customers_panel(metrics: DataFrame, n: int = 10) -> DataFrame:
    return top_customers(metrics, n).select(
        "name", "email", "total_orders", "total_items_purchased"
    )


def vip_customers(metrics: DataFrame, n: int = 20) -> DataFrame:
    return top(metrics, "total_orders", "customer_id", n).select(
        "name",
        "email",
        "total_orders",
        "total_items_purchased",
        "customer_lifespan_days",
        "last_order_date",
    )


def order_count_histogram(metrics: DataFrame) -> DataFrame:
    """How many customers have how many orders."""
    return metrics.groupBy(F.col("total_orders").alias("orders_count")).agg(
        F.count(F.lit(1)).alias("customer_count")
    )


def registration_trend(customers: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    since = as_of_micros(as_of) - days * MICROS_PER_DAY
    recent = customers.filter(F.col("created_at") >= since)
    return recent.groupBy(day_of(F.col("created_at")).alias("date")).agg(
        F.count(F.lit(1)).alias("new_customers")
    )


def customer_overview(customers: DataFrame, orders: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Three headline numbers as (metric, value) rows."""
    since = as_of_micros(as_of) - 7 * MICROS_PER_DAY
    counted = customers.agg(
        F.count(F.lit(1)).alias("everyone"),
        F.count_if(F.col("created_at") >= since).alias("new"),
    )
    pairs = F.array(
        F.struct(F.lit("Total Customers").alias("metric"), F.col("everyone").alias("value")),
        F.struct(F.lit("New Customers (Last 7d)").alias("metric"), F.col("new").alias("value")),
    )
    active = orders.agg(F.count_distinct("customer_id").alias("value")).select(
        F.lit("Active Customers (with orders)").alias("metric"), "value"
    )
    return counted.select(F.inline(pairs)).unionByName(active)
