"""What each change takes away and what it adds, as a feed for live figures.

The newest row of every key is kept beside the query's checkpoint. A newer change sends the
live row it replaces with weight -1 and its own, unless it is a delete, with +1. Late and
repeated changes send nothing. Sums over the feed are therefore sums over the live
rows, whatever the order the changes came in, and no reader has to look at the rows kept.

The feed is a folder with a folder for each batch, which appears once and whole; any
number of queries may stream it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import PipelineConfig
from tidemark.operators.changes import valid_changes
from tidemark.operators.state import POSITION, latest_versions
from tidemark.schemas import TableSpec
from tidemark.session import folder_exists, publish_folder
from tidemark.streaming.jobs import set_trigger
from tidemark.streaming.kept import BATCH, KeptRows

WEIGHT = "_weight"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state lies on the executors' disks; a provider that the session names stays."""
    if spark.conf.get(_PROVIDER, None) in (None, "", _DEFAULT_PROVIDER):
        spark.conf.set(_PROVIDER, _ROCKSDB)


_DEFAULT_PROVIDER = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def feed_schema(spec: TableSpec) -> T.StructType:
    names = (spec.key, *spec.columns)
    return T.StructType([*(spec.flat_schema()[c] for c in names), T.StructField(WEIGHT, T.IntegerType())])


def _position() -> Column:
    return F.struct(*(F.col(c) for c in POSITION))


def _first_newest(spec: TableSpec, rows: DataFrame) -> DataFrame:
    """The newest row of each key; of equal positions, that of the first batch, which was sent."""
    newest_first = Window.partitionBy(spec.key).orderBy(*(F.col(c).desc() for c in POSITION), BATCH)
    return rows.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1")


def retractions(before: DataFrame, newest: DataFrame, spec: TableSpec) -> DataFrame:
    """The feed of a batch: its newest row of each key, and the newest of those keys before it."""

    def values() -> Column:
        return F.when(F.col("_deleted") == 0, F.struct(*spec.columns))

    held = before.select(spec.key, values().alias("_old"), _position().alias("_held"))
    offered = newest.select(spec.key, values().alias("_new"), _position().alias("_offered"))
    newer = F.col("_held").isNull() | (F.col("_offered") > F.col("_held"))
    changed = offered.join(held, spec.key, "left").filter(newer & ~F.col("_old").eqNullSafe(F.col("_new")))
    both = F.array(*(F.struct(F.col(c).alias("row"), F.lit(w).alias(WEIGHT)) for c, w in (("_old", -1), ("_new", 1))))
    sent = changed.select(spec.key, F.inline(F.filter(both, lambda step: step["row"].isNotNull())))
    return sent.select(spec.key, *(F.col("row")[c].alias(c) for c in spec.columns), WEIGHT)


def start_feed(
    rows: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    config: PipelineConfig,
    available_now: bool = False,
) -> StreamingQuery:
    """Start writing the feed of a stream of topic rows to the folder ``path``."""
    spark = rows.sparkSession
    merge = lambda kept: _first_newest(spec, kept)
    kept = KeptRows(spark, f"{checkpoint}/newest", spec.flat_schema(), [spec.key], merge)

    def write(changes: DataFrame, batch_id: int) -> None:
        name = f"batch_id={batch_id}"
        if folder_exists(spark, f"{path}/{name}"):
            return  # sent by an attempt that died before its commit
        newest = kept.put(latest_versions(changes, spec.key), batch_id)
        feed = retractions(kept.before(newest, batch_id), newest, spec)
        feed.write.mode("overwrite").parquet(f"{path}/_staged/{name}")
        publish_folder(spark, f"{path}/_staged/{name}", f"{path}/{name}")

    writer = (
        valid_changes(rows, spec)
        .writeStream.queryName(f"{spec.name} feed {checkpoint}")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return set_trigger(writer, config, available_now).start()


def read_feed(spark: SparkSession, path: str, spec: TableSpec, files_per_trigger: int | None = None) -> DataFrame:
    """The feed as a stream."""
    reader = spark.readStream.schema(feed_schema(spec))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).select(*feed_schema(spec).fieldNames())


def net_rows(feed: DataFrame, spec: TableSpec) -> DataFrame:
    """The live rows that a feed, read as a table, amounts to."""
    names = [spec.key, *spec.columns]
    summed = feed.groupBy(*names).agg(F.sum(WEIGHT).alias(WEIGHT))
    return summed.filter(F.col(WEIGHT) > 0).select(*names)
