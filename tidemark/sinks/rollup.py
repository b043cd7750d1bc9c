"""The daily rollup table.

A run appends the figures of its days under the time of the run, and the newest
row of a date is the one that counts, so running a day again replaces it. Rows
are tiny; one file per run is far cheaper to list and read than one folder per
date. ``rebuild_rollup`` writes the table anew as a single run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_of_micros
from tidemark.functions.times import MICROS_PER_DAY, AsOf, day_of, day_start
from tidemark.operators.state import latest_versions
from tidemark.plans.sales import rollup_measures

_MEASURES = (
    "total_orders",
    "total_customers",
    "total_items_sold",
    "unique_products_sold",
    "orders_with_quantity",
)
ROLLUP_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        *(T.StructField(m, T.LongType()) for m in _MEASURES),
        T.StructField("run_micros", T.LongType()),
    ]
)


def _write(rows: DataFrame, path: str, mode: str) -> None:
    run = F.unix_micros(F.current_timestamp())
    rows = rows.withColumn("run_micros", run).select(*ROLLUP_SCHEMA.fieldNames())
    # At most one row per calendar day.
    rows.repartition(1).write.mode(mode).parquet(path)


def roll_yesterday(orders: DataFrame, path: str, as_of: AsOf = None) -> None:
    """Put in the figures of the day before ``as_of``.

    A day without live orders is written with zeros, so that an earlier run's
    figures do not survive.
    """
    today = day_start(as_of_micros(as_of))
    yesterday = today - MICROS_PER_DAY
    time = F.col("order_time")
    measures = rollup_measures(orders.filter((time >= yesterday) & (time < today)))
    the_day = orders.sparkSession.range(1).select(day_of(yesterday).alias("date"))
    _write(the_day.join(measures, "date", "left").fillna(0, list(_MEASURES)), path, "append")


def rebuild_rollup(orders: DataFrame, path: str) -> None:
    """Write all days anew."""
    _write(rollup_measures(orders), path, "overwrite")


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The newest figures of each day that has orders, the average worked out from sum and count."""
    rows = spark.read.schema(ROLLUP_SCHEMA).parquet(path)
    versioned = rows.select(
        "date",
        *_MEASURES,
        F.col("run_micros").alias("_version"),
        F.lit(0).alias("partition"),
        F.lit(0).alias("offset"),
    )
    average = F.col("total_items_sold") / F.col("orders_with_quantity")
    return (
        latest_versions(versioned, key="date")
        .filter(F.col("total_orders") > 0)
        .select(
            "date",
            "total_orders",
            "total_customers",
            "total_items_sold",
            "unique_products_sold",
            F.when(F.col("orders_with_quantity") > 0, average).alias("avg_items_per_order"),
        )
    )
