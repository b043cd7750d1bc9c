"""One streaming query per table: topic rows in, change log out.

The path is map-only, unless repeated deliveries are to be dropped. Nothing is dropped
for being late: versions decide.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.config import PipelineConfig
from tidemark.operators.changes import add_processing_metadata, triage, valid_changes
from tidemark.schemas import TableSpec
from tidemark.sinks.changelog import ChangeLog
from tidemark.sinks.tables import write_table

log = logging.getLogger(__name__)

BatchWriter = Callable[[DataFrame, int], None]


def log_writer(
    changelog: ChangeLog,
    ckpt: int,
    compact_every: int | None = None,
    drop_folded: bool = False,
    tombstone_ms: int | None = None,
) -> BatchWriter:
    """Writes each micro-batch to its own folder of the change log.

    Every ``compact_every`` batches the ones before are folded into the state, and
    with ``drop_folded`` their changes leave the log.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        changelog.write_batch(batch, batch_id, ckpt)
        changelog.maintain(batch_id, ckpt, compact_every, drop_folded, tombstone_ms)

    return write


def jdbc_writer(config: PipelineConfig, table: str) -> BatchWriter:
    """Appends the valid changes of each micro-batch to a JDBC table."""
    if config.jdbc is None:
        raise ValueError("no JDBC target configured")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.filter(F.col("reason").isNull())
        rows = rows.drop("reason", "key_text", "value_text", "partition", "offset")
        write_table(rows, config.jdbc, table)

    return write


def without_repeats(rows: DataFrame, within: str) -> DataFrame:
    """Topic rows without those delivered again ``within`` a time of the first delivery.

    The time is that of processing, so nothing is ever late and no change is lost, however
    old; state is kept for that long only. What is repeated later passes, and versions
    decide.
    """
    seen = rows.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", within)
    return seen.dropDuplicatesWithinWatermark(["topic", "partition", "offset"]).drop("_seen")


def start_table(
    rows: DataFrame,
    spec: TableSpec,
    write: BatchWriter,
    checkpoint: str,
    config: PipelineConfig,
    available_now: bool = False,
) -> StreamingQuery:
    """Start a table's query on a stream of topic rows.

    ``available_now`` works off what is there in micro-batches and stops. Row
    counts appear as the observed metric ``changes`` of the query's progress. With
    ``config.repeats_within`` repeated deliveries are dropped before anything else.
    """
    if config.repeats_within:
        rows = without_repeats(rows, config.repeats_within)
    triaged = triage(rows, spec).observe(
        "changes", F.count(F.lit(1)).alias("rows"), F.count("reason").alias("rejected")
    )
    writer = (
        triaged.writeStream.queryName(f"{spec.name} {checkpoint}")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return set_trigger(writer, config, available_now).start()


def start_debug(
    rows: DataFrame,
    spec: TableSpec,
    config: PipelineConfig,
    sink: str = "console",
    available_now: bool = False,
) -> StreamingQuery:
    """Print valid changes, untruncated, with operation and processing metadata."""
    shown = add_processing_metadata(valid_changes(rows, spec, include_op=True))
    writer = (
        shown.writeStream.queryName(f"{spec.name}_debug")
        .format(sink)
        .outputMode("append")
        .option("truncate", "false")
    )
    return set_trigger(writer, config, available_now).start()


def set_trigger(writer: DataStreamWriter, config: PipelineConfig, available_now: bool) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=config.trigger_interval)


@dataclass(frozen=True)
class TableRun:
    """A started table: its query and, if it writes one, its change log."""

    query: StreamingQuery
    changelog: ChangeLog | None


def run_tables(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    config: PipelineConfig,
    available_now: bool = False,
) -> dict[str, TableRun]:
    """Start one query per table in this session; ``sources`` are streams of topic rows.

    ``config.sink`` decides whether changes go to change logs below ``root`` or to
    the JDBC tables ``<table>_cdc``.
    """
    config.validate()
    runs = {}
    for table, rows in sources.items():
        spec = config.spec(table)
        if config.debug:
            runs[table] = TableRun(start_debug(rows, spec, config, available_now=available_now), None)
            continue
        if config.sink == "jdbc":
            changelog, write = None, jdbc_writer(config, f"{table}_cdc")
        else:
            changelog = ChangeLog(spark, f"{root}/{table}", spec)
            write = log_writer(
                changelog,
                config.checkpoint_version,
                config.compact_every,
                config.drop_folded,
                config.tombstone_days and config.tombstone_days * 86_400_000,
            )
        query = start_table(
            rows,
            spec,
            write,
            config.checkpoint_for(table, f"{root}/checkpoints"),
            config,
            available_now,
        )
        log.info("started %s", query.name)
        runs[table] = TableRun(query, changelog)
    return runs


def finish(runs: Mapping[str, TableRun]) -> None:
    """Wait until every query has ended; a failed one raises."""
    for run in runs.values():
        run.query.awaitTermination()


def stop(runs: Mapping[str, TableRun]) -> None:
    for run in runs.values():
        run.query.stop()


def status(spark: SparkSession) -> list[dict]:
    """Name, state and last progress of every active query."""
    return [
        {
            "name": q.name,
            "id": str(q.id),
            "active": q.isActive,
            "status": q.status,
            "progress": q.lastProgress,
        }
        for q in spark.streams.active
    ]
