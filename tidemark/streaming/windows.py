"""Orders of the last 24 hours by hour of day, kept while changes stream in.

Retractions are summed in event-time windows of a minute. A watermark behind the
newest order evicts windows that no question reaches any more, so the state holds
minutes of a few days however long the stream runs. Rows that come later than that
belong to evicted windows and are not waited for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import PipelineConfig
from tidemark.functions.times import MICROS_PER_DAY, AsOf, as_of_micros, hour_of
from tidemark.streaming.jobs import set_trigger
from tidemark.streaming.retractions import WEIGHT, use_rocksdb

STEP = "1 minute"
#: How far behind the newest order a window is kept: the day that is asked for, and
#: what the newest live order may fall back when newer ones are deleted.
KEPT = "3 days"
_SCHEMA = T.StructType(
    [
        *(T.StructField(c, T.LongType()) for c in ("start_us", "orders", "items", "with_quantity")),
        T.StructField("ckpt", T.IntegerType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def minute_sums(feed: DataFrame, kept: str = KEPT) -> DataFrame:
    """A stream of orders' retractions as sums of each minute that changes."""
    use_rocksdb(feed.sparkSession)
    known = F.when(F.col("quantity").isNotNull(), F.col(WEIGHT))
    rows = feed.filter("order_time IS NOT NULL").withColumn("at", F.timestamp_micros("order_time"))
    return (
        rows.withWatermark("at", kept)
        .groupBy(F.window("at", STEP))
        .agg(
            F.sum(WEIGHT).alias("orders"),
            F.coalesce(F.sum(F.col("quantity") * F.col(WEIGHT)), F.lit(0)).alias("items"),
            F.coalesce(F.sum(known), F.lit(0)).alias("with_quantity"),
        )
        .select(F.unix_micros("window.start").alias("start_us"), "orders", "items", "with_quantity")
    )


def start_hourly_orders(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    config: PipelineConfig,
    ckpt: int = 1,
    kept: str = KEPT,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the sums of recent minutes in the folder ``path``; a batch owns its folder."""

    def write(sums: DataFrame, batch_id: int) -> None:
        sums.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{path}/ckpt={ckpt}/batch_id={batch_id}"
        )

    writer = (
        minute_sums(feed, kept)
        .writeStream.queryName(f"hourly orders {checkpoint}")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return set_trigger(writer, config, available_now).start()


def recent_minutes(spark: SparkSession, path: str, ckpt: int = 1) -> DataFrame:
    """The newest sums of each minute that has orders."""
    rows = spark.read.schema(_SCHEMA).parquet(path).filter(F.col("ckpt") == ckpt)
    newest = Window.partitionBy("start_us").orderBy(F.desc("batch_id"))
    latest = rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1")
    return latest.filter("orders > 0").select("start_us", "orders", "items", "with_quantity")


def read_hourly_orders(spark: SparkSession, path: str, as_of: AsOf = None, ckpt: int = 1) -> DataFrame:
    """As ``plans.sales.hourly_orders``, from whole minutes: the first one counts in full."""
    since = as_of_micros(as_of) - MICROS_PER_DAY
    minutes = recent_minutes(spark, path, ckpt).filter(F.col("start_us") >= since)
    items = F.when(F.sum("with_quantity") > 0, F.sum("items")).alias("total_items")
    return minutes.groupBy(hour_of(F.col("start_us")).alias("hour")).agg(F.sum("orders").alias("order_count"), items)
