"""Sales over live orders: by day, by month, by hour of day, and the daily rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_of_micros, day_of, hour_of, month_of
from tidemark.functions.times import MICROS_PER_DAY, AsOf, day_start

#: What is counted once a day.
_COUNTED = ("customer_id", "product_id")


def _day_figures(orders: DataFrame) -> DataFrame:
    """Sums and exact distinct counts of each day, in one pass.

    Every order is given twice, for its customer and its product. Grouping by value
    first spreads a busy day over many tasks, and leaves what has to be counted only.
    """
    kinds = F.array(*(F.struct(F.lit(i).alias("kind"), F.col(c).alias("value")) for i, c in enumerate(_COUNTED)))
    given = orders.select(day_of(F.col("order_time")).alias("date"), F.inline(kinds), "quantity")
    values = given.groupBy("date", "kind", "value").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("quantity").alias("items"), F.count("quantity").alias("known")
    )
    customer, product = (F.col("kind") == i for i in range(2))
    return values.groupBy("date").agg(
        *(F.sum(F.when(customer, F.col(c))).alias(c) for c in ("orders", "items", "known")),
        F.count(F.when(customer, F.col("value"))).alias("customers"),
        F.count(F.when(product, F.col("value"))).alias("products"),
    )


def daily_sales(orders: DataFrame) -> DataFrame:
    return _day_figures(orders).select(
        "date",
        F.col("orders").alias("total_orders"),
        F.col("items").alias("total_items_sold"),
        F.col("customers").alias("unique_customers"),
        F.col("products").alias("unique_products_sold"),
        F.when(F.col("known") > 0, F.col("items") / F.col("known")).alias("avg_items_per_order"),
    )


def daily_sales_since(orders: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Days from ``days`` before today on. The bound is on the raw column, so it reaches the scan."""
    start = day_start(as_of_micros(as_of)) - days * MICROS_PER_DAY
    recent = orders.filter(F.col("order_time") >= start)
    return recent.groupBy(day_of(F.col("order_time")).alias("date")).agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("quantity").alias("total_items_sold")
    )


def monthly_sales(orders: DataFrame) -> DataFrame:
    return orders.groupBy(month_of(F.col("order_time")).alias("month")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("quantity").alias("total_items_sold"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.round(F.avg("quantity"), 2).alias("avg_items_per_order"),
    )


def hourly_orders(orders: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Orders of the last 24 hours by hour of day."""
    since = as_of_micros(as_of) - MICROS_PER_DAY
    recent = orders.filter(F.col("order_time") >= since)
    return recent.groupBy(hour_of(F.col("order_time")).alias("hour")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("quantity").alias("total_items"),
    )


def hourly_panel(orders: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Hour labels such as ``7:00`` with their order counts."""
    label = F.concat(F.col("hour").cast("string"), F.lit(":00"))
    return hourly_orders(orders, as_of).select(label.alias("hour_label"), "order_count")


def rollup_measures(orders: DataFrame) -> DataFrame:
    """What the rollup table stores per day.

    Sum and count are kept instead of the average; distinct counts belong to
    the day as a whole and are recomputed with it, never added up.
    """
    return _day_figures(orders).select(
        "date",
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("total_customers"),
        F.col("items").alias("total_items_sold"),
        F.col("products").alias("unique_products_sold"),
        F.col("known").alias("orders_with_quantity"),
    )
