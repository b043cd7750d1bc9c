"""Topic readers. All return rows of ``TOPIC_ROW``.

The Kafka connector is a separate Spark package
(``org.apache.spark:spark-sql-kafka-0-10``); the session must be started with it.
A folder of parquet files with the same columns can stand in for a topic.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import PipelineConfig
from tidemark.schemas import TOPIC_ROW


def topic_options(
    config: PipelineConfig,
    topics: Sequence[str],
    starting_offsets: str | None = None,
    since: datetime | None = None,
) -> dict[str, str]:
    """Options both readers share. ``since`` starts at a time instead of an offset policy."""
    options = {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "subscribe": ",".join(topics),
    }
    if since is not None:
        when = since if since.tzinfo else since.replace(tzinfo=timezone.utc)
        options["startingTimestamp"] = str(int(when.timestamp() * 1000))
        options["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        options["startingOffsets"] = starting_offsets or config.starting_offsets
    if config.min_partitions:
        options["minPartitions"] = str(config.min_partitions)
    return options


def read_topic_stream(
    spark: SparkSession,
    config: PipelineConfig,
    topics: Sequence[str],
    starting_offsets: str | None = None,
) -> DataFrame:
    options = topic_options(config, topics, starting_offsets)
    if config.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def read_topic_batch(
    spark: SparkSession,
    config: PipelineConfig,
    topics: Sequence[str],
    starting_offsets: str = "earliest",
    since: datetime | None = None,
) -> DataFrame:
    """Everything from the start (or from ``since``) to the present end."""
    options = topic_options(config, topics, starting_offsets, since)
    return spark.read.format("kafka").options(**options).load()


def read_topic_folder(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC_ROW).parquet(path)


def read_topic_folder_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(TOPIC_ROW)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
