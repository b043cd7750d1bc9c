"""Looking at raw topic rows: previews, counts, summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    age_label,
    as_of_micros,
    table_of_topic,
    utc_timestamp,
    utf8_text,
)
from tidemark.functions.times import MICROS_PER_MINUTE, AsOf


def all_topics(*topics: DataFrame) -> DataFrame:
    """Several topics as one frame."""
    return reduce(DataFrame.unionByName, topics)


def of_topics(rows: DataFrame, topics: Sequence[str]) -> DataFrame:
    return rows.filter(F.col("topic").isin(*topics))


def of_operation(rows: DataFrame, op: str) -> DataFrame:
    """Rows whose envelope carries the operation."""
    return rows.filter(F.get_json_object(F.col("value").cast("string"), "$.op") == op)


def preview(
    rows: DataFrame,
    limit: int = 10,
    as_of: AsOf = None,
    minutes: int | None = None,
    topics: Sequence[str] | None = None,
) -> DataFrame:
    """Newest ``limit`` messages as text with their age, optionally of the last minutes only."""
    now = as_of_micros(as_of)
    stamp = F.unix_micros("timestamp")
    if topics is not None:
        rows = of_topics(rows, topics)
    if minutes is not None:
        rows = rows.filter(stamp >= now - minutes * MICROS_PER_MINUTE)
    newest = rows.orderBy(
        F.col("timestamp").desc(), "topic", "partition", F.col("offset").desc()
    ).limit(limit)
    return newest.select(
        "topic",
        "partition",
        "offset",
        utc_timestamp(stamp).alias("timestamp"),
        utf8_text(F.col("key")).alias("key"),
        F.col("value").cast("string").alias("value"),
        age_label(stamp, now).alias("age"),
    )


def newest_per_partition(rows: DataFrame, limit: int = 10) -> DataFrame:
    """The last ``limit`` messages of every partition of every topic.

    Rows that share an offset are ordered by time and key. Spark cuts every map task's output to ``limit`` rows a partition before the
    shuffle, so a busy partition costs no more there than any other.
    """
    newest_first = Window.partitionBy("topic", "partition").orderBy(
        *(F.col(c).desc() for c in ("offset", "timestamp", "key"))
    )
    ranked = rows.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.filter(F.col("_rank") <= limit).drop("_rank")


def summary(rows: DataFrame) -> DataFrame:
    """Number of messages, time of the newest, number of topics seen."""
    return rows.agg(
        F.count(F.lit(1)).alias("total_messages"),
        utc_timestamp(F.max(F.unix_micros("timestamp"))).alias("latest_message"),
        F.count_distinct("topic").alias("active_topics"),
    )


def counts_by_table(rows: DataFrame) -> DataFrame:
    return rows.groupBy(table_of_topic(F.col("topic")).alias("table_name")).agg(
        F.count(F.lit(1)).alias("events")
    )


def counts_by_op(rows: DataFrame) -> DataFrame:
    """Messages per topic and operation; messages without one count under NULL."""
    op = F.get_json_object(F.col("value").cast("string"), "$.op")
    return rows.groupBy("topic", op.alias("op")).agg(F.count(F.lit(1)).alias("events"))
