"""Daily sales kept up to date while order changes stream in.

Orders, items and averages are sums over the retraction feed. A distinct count is
the number of values whose references, summed over the feed, are above none: the
references of each day and value are kept beside the query's checkpoint, and only a value
that comes or goes changes the figure. What a batch sends is a handful of rows a day;
reading adds them up. No batch looks at the orders themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import PipelineConfig
from tidemark.functions import day_of
from tidemark.streaming.jobs import set_trigger
from tidemark.streaming.kept import KeptRows
from tidemark.streaming.retractions import WEIGHT

#: What is counted of a day: its orders' customers and products.
_KINDS = {"customers": "customer_id", "products": "product_id"}
_MEASURES = ("orders", "items", "with_quantity", *_KINDS)
_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        *(T.StructField(m, T.LongType()) for m in _MEASURES),
        T.StructField("ckpt", T.IntegerType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
#: Orders without a time have a day of their own, which ``dated`` tells from the first of all.
_KEY = ["dated", "day", "kind", "value"]
_REFERENCES = T.StructType(
    [
        T.StructField("dated", T.BooleanType()),
        T.StructField("day", T.DateType()),
        T.StructField("kind", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("references", T.LongType()),
    ]
)


def references_by_day(feed: DataFrame) -> DataFrame:
    """How the number of live rows of each day that refer to each value changes."""
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).cast("long").alias("value")) for k, c in _KINDS.items()))
    date = day_of(F.col("order_time"))
    day = F.coalesce(date, F.lit("1970-01-01").cast("date")).alias("day")
    rows = feed.select(date.isNotNull().alias("dated"), day, F.inline(kinds), WEIGHT).filter("value IS NOT NULL")
    return summed(rows.withColumnRenamed(WEIGHT, "references"))


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_KEY).agg(F.sum("references").alias("references")).filter("references <> 0")


def daily_steps(feed: DataFrame, before: DataFrame, changed: DataFrame) -> DataFrame:
    """How the daily figures change, at most one row a day.

    ``changed`` are the references that the feed changes and by how many, ``before`` those held.
    """
    weight, quantity = F.col(WEIGHT).cast("long"), F.col("quantity")
    sums = feed.groupBy(day_of(F.col("order_time")).alias("date")).agg(
        F.sum(weight).alias("orders"),
        F.sum(quantity * weight).alias("items"),
        F.sum(F.when(quantity.isNotNull(), weight)).alias("with_quantity"),
    )
    held = F.coalesce("held", F.lit(0))
    there = lambda n: (n > 0).cast("long")
    moved = changed.join(before.withColumnRenamed("references", "held"), _KEY, "left").select(
        F.when(F.col("dated"), F.col("day")).alias("date"), "kind", (there(held + F.col("references")) - there(held)).alias("step")
    )
    of_kind = (F.sum(F.when(F.col("kind") == kind, F.col("step"))).alias(kind) for kind in _KINDS)
    values = moved.filter("step <> 0").groupBy("date").agg(*of_kind)
    both = sums.unionByName(values, allowMissingColumns=True)
    return both.groupBy("date").agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in _MEASURES))


def start_daily_sales(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    config: PipelineConfig,
    ckpt: int = 1,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the daily figures of a stream of orders' retractions in the folder ``path``.

    A batch owns its folder, so a batch that is done again replaces its steps.
    """
    kept = KeptRows(feed.sparkSession, f"{checkpoint}/references", _REFERENCES, _KEY, summed)

    def write(rows: DataFrame, batch_id: int) -> None:
        changed = kept.put(references_by_day(rows), batch_id)
        figures = daily_steps(rows, kept.before(changed, batch_id), changed)
        figures.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{path}/ckpt={ckpt}/batch_id={batch_id}"
        )

    writer = (
        feed.writeStream.queryName(f"daily sales {checkpoint}")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return set_trigger(writer, config, available_now).start()


def read_daily_sales(spark: SparkSession, path: str, ckpt: int = 1) -> DataFrame:
    """The figures of each day that has orders, as ``plans.sales.daily_sales`` gives them.

    A new checkpoint version streams the feed anew, so versions are not added up.
    """
    rows = spark.read.schema(_SCHEMA).parquet(path).filter(F.col("ckpt") == ckpt)
    summed = rows.groupBy("date").agg(*(F.sum(m).alias(m) for m in _MEASURES)).filter("orders > 0")
    average = F.when(F.col("with_quantity") > 0, F.col("items") / F.col("with_quantity"))
    return summed.select(
        "date",
        F.col("orders").alias("total_orders"),
        F.when(F.col("with_quantity") > 0, F.col("items")).alias("total_items_sold"),
        F.col("customers").alias("unique_customers"),
        F.col("products").alias("unique_products_sold"),
        average.alias("avg_items_per_order"),
    )
