"""Exact distinct counts that can be merged: bitmaps by day and by bucket of ids.

A count of one period says nothing about a longer one, but its bitmaps do: those of
days are or-ed into those of weeks, months or any other span, and counted then. A
bucket holds 32,768 neighbouring ids in 4 KB, so days should be many orders long; for
few and far ids reference counts (``streaming.metrics``) are smaller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_of_micros, day_of
from tidemark.functions.times import MICROS_PER_DAY, AsOf, day_start
from tidemark.operators.state import latest_versions

COUNTED = ("customer_id", "product_id")
_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("counted", T.StringType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("bitmap", T.BinaryType()),
        T.StructField("run_micros", T.LongType()),
    ]
)


def daily_bitmaps(orders: DataFrame, columns: Sequence[str] = COUNTED) -> DataFrame:
    """``date``, ``counted`` (the column), ``bucket`` and ``bitmap`` of the ids in the day's orders."""
    ids = F.array(*(F.struct(F.lit(c).alias("counted"), F.col(c).alias("value")) for c in columns))
    given = orders.select(day_of(F.col("order_time")).alias("date"), F.inline(ids)).filter("value IS NOT NULL")
    return given.groupBy("date", "counted", F.bitmap_bucket_number("value").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bitmap")
    )


def merged(bitmaps: DataFrame, period: Column) -> DataFrame:
    """Bitmaps of a longer ``period``, or-ed from those of its parts."""
    grouped = bitmaps.groupBy(period.alias("period"), "counted", "bucket")
    return grouped.agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def unique_counts(bitmaps: DataFrame, by: str = "period") -> DataFrame:
    """``unique_<column>`` for each value of ``by``; zero where a period has none of a column's ids."""
    counts = bitmaps.select(by, "counted", F.bitmap_count("bitmap").alias("n"))
    names = (c.removesuffix("_id") for c in COUNTED)
    sums = (F.sum(F.when(F.col("counted") == c, F.col("n")).otherwise(0)).alias(f"unique_{n}s") for c, n in zip(COUNTED, names))
    return counts.groupBy(by).agg(*sums)


# -- kept by day ----------------------------------------------------------


def _write(bitmaps: DataFrame, days: DataFrame, path: str, mode: str) -> None:
    """Append a run's bitmaps; a row without bucket says that the run did the day."""
    run = F.unix_micros(F.current_timestamp())
    marks = days.select("date", *(F.lit(None).cast(_SCHEMA[c].dataType).alias(c) for c in ("counted", "bucket", "bitmap")))
    rows = bitmaps.unionByName(marks).withColumn("run_micros", run)
    rows.select(*_SCHEMA.fieldNames()).write.mode(mode).parquet(path)


def rebuild_uniques(orders: DataFrame, path: str) -> None:
    """Write the bitmaps of all days anew."""
    bitmaps = daily_bitmaps(orders)
    _write(bitmaps, bitmaps.select("date").distinct(), path, "overwrite")


def roll_uniques(orders: DataFrame, path: str, as_of: AsOf = None) -> None:
    """Put in the bitmaps of the day before ``as_of``, in place of an earlier run's."""
    today = day_start(as_of_micros(as_of))
    time, yesterday = F.col("order_time"), today - MICROS_PER_DAY
    day = orders.sparkSession.range(1).select(day_of(yesterday).alias("date"))
    _write(daily_bitmaps(orders.filter((time >= yesterday) & (time < today))), day, path, "append")


def read_uniques(spark: SparkSession, path: str) -> DataFrame:
    """The newest run's bitmaps of every day."""
    rows = spark.read.schema(_SCHEMA).parquet(path)
    runs = rows.filter("bucket IS NULL").select(
        "date", F.col("run_micros").alias("_version"), F.lit(0).alias("partition"), F.lit(0).alias("offset")
    )
    newest = latest_versions(runs, "date").select(F.col("date").alias("on"), F.col("_version").alias("run"))
    same = F.col("date").eqNullSafe(F.col("on")) & (F.col("run_micros") == F.col("run"))
    return rows.filter("bucket IS NOT NULL").join(newest, same).select("date", "counted", "bucket", "bitmap")
