"""Relational questions over the live tables. All joins are equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import utc_timestamp


def enrich_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    carry: Sequence[str] = (),
    buyers_first: bool = False,
) -> DataFrame:
    """Each live order with its live customer and product, and the columns to ``carry`` along.

    The side that leaves fewer orders is best joined first; without ``buyers_first`` it is the products.

    The order side may be skewed towards one customer or product; adaptive
    execution splits such partitions, and the other side of each join is unique.
    """
    buyer = customers.select(
        F.col("id").alias("customer_id"),
        F.col("name").alias("customer_name"),
        F.col("email").alias("customer_email"),
        *(c for c in carry if c in customers.columns),
    )
    item = products.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        F.col("price").alias("product_price"),
        *(c for c in carry if c in products.columns),
    )
    sides = [(item, "product_id"), (buyer, "customer_id")]
    (first, first_key), (second, second_key) = sides[::-1] if buyers_first else sides
    total = (F.col("quantity") * F.col("product_price")).cast("decimal(20,2)")
    return (
        orders.select(
            "id", "customer_id", "product_id", "quantity", "order_time", *(c for c in carry if c in orders.columns)
        )
        .join(first, first_key)
        .join(second, second_key)
        .select(
            "id",
            "quantity",
            utc_timestamp(F.col("order_time")).alias("order_time"),
            "customer_name",
            "customer_email",
            "product_name",
            "product_price",
            total.alias("total_amount"),
            *carry,
        )
    )


def without_orders(parents: DataFrame, orders: DataFrame, reference: str) -> DataFrame:
    """Parents no order points at. The order side is made distinct before it is shuffled."""
    used = orders.select(F.col(reference).alias("id")).distinct()
    return parents.join(used, "id", "left_anti")


def delete_candidates(
    parents: DataFrame, orders: DataFrame, reference: str, limit: int
) -> DataFrame:
    """Rows of ``parents`` among the first ``limit`` ids that no order points at."""
    targets = without_orders(parents, orders, reference).select("id").orderBy("id").limit(limit)
    return parents.join(targets, "id", "left_semi")


def deletions(targets: DataFrame, columns: list[str], at_ms: int) -> DataFrame:
    """Delete changes for the given rows."""
    blank = {c: F.lit(None).cast(targets.schema[c].dataType) for c in columns}
    return targets.withColumns(
        {**blank, "_version": F.lit(at_ms).cast("bigint"), "_deleted": F.lit(1)}
    )


def deletable(parents: DataFrame, orders: DataFrame, reference: str) -> DataFrame:
    """For every parent the number of orders pointing at it, and whether it may go."""
    used = orders.groupBy(F.col(reference).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    count = F.coalesce(F.col("n"), F.lit(0))
    return (
        parents.select("id")
        .join(used, "id", "left")
        .select("id", count.alias("order_count"), (count == 0).alias("deletable"))
    )
