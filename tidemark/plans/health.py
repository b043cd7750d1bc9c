"""Activity, freshness and sizes of the tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_of_micros, minutes_crossed, utc_timestamp
from tidemark.functions.times import AsOf


def recent_activity(
    orders: DataFrame, customers: DataFrame, products: DataFrame, since: AsOf = None
) -> DataFrame:
    """Live rows and newest event time per table; all of them unless ``since`` is given."""
    parts = []
    for label, rows, time in (
        ("orders", orders, "order_time"),
        ("customers", customers, "created_at"),
        ("products", products, "created_at"),
    ):
        if since is not None:
            rows = rows.filter(F.col(time) >= as_of_micros(since))
        totals = rows.agg(F.count(F.lit(1)).alias("total_records"), F.max(time).alias("last_us"))
        parts.append(
            totals.select(
                F.lit(label).alias("activity_type"),
                "total_records",
                utc_timestamp(F.col("last_us")).alias("last_activity"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def data_freshness(logs: Mapping[str, DataFrame], as_of: AsOf = None) -> DataFrame:
    """Change rows, newest version and its age per table, deletes included."""
    parts = []
    for label, changes in logs.items():
        newest = F.col("last_ms") * 1000
        totals = changes.agg(
            F.count(F.lit(1)).alias("total_records"), F.max("_version").alias("last_ms")
        )
        parts.append(
            totals.select(
                F.lit(label).alias("table_name"),
                "total_records",
                utc_timestamp(newest).alias("last_update"),
                minutes_crossed(newest, as_of_micros(as_of)).alias("minutes_since_last_update"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
