
from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracles
from tidemark import fixtures
from tidemark.config import PipelineConfig
from tidemark.functions import (
    decode_decimal,
    encode_decimal,
    safe_cast,
    utc_timestamp,
    utf8_text,
)
from tidemark.functions.times import MICROS_PER_DAY, day_start
from tidemark.operators import changes as change_ops
from tidemark.operators import events, joins, ranking
from tidemark.operators.decode import decode
from tidemark.operators.deltas import applied, enriched_delta, table_delta
from tidemark.operators.drift import drift
from tidemark.operators.snapshot import settled_chunk
from tidemark.operators.state import current_rows, latest_versions, live, merge_changes
from tidemark.plans import customers, health, products, quality, sales, uniques
from tidemark.session import let_workers_import, new_run_folder
from tidemark.sinks.changelog import ChangeLog
from tidemark.sinks.rollup import read_rollup, rebuild_rollup, roll_yesterday
from tidemark.sources.kafka import read_topic_folder, read_topic_folder_stream
from tidemark.sources.tables import key_bounds, range_of, snapshot_in_order
from tidemark.streaming.jobs import finish, log_writer, run_tables, start_table
from tidemark.streaming.live import (
    read_leaders,
    read_orphans,
    references,
    start_leaders,
    start_orphans,
)
from tidemark.streaming.metrics import read_daily_sales, start_daily_sales
from tidemark.streaming.progress import ProgressTable, read_progress, throughput
from tidemark.streaming.retractions import read_feed, start_feed
from tidemark.streaming.windows import read_hourly_orders, recent_minutes, start_hourly_orders

try:
    import corpus_pipeline
    from tidemark.llm import entries as llm_entries
except ModuleNotFoundError as missing:
    # the library works without this subpackage; any other missing module is an error
    if missing.name not in ("corpus_pipeline", "tidemark.llm"):
        raise
    llm_entries = None

Query = Callable[[SparkSession, str], DataFrame]

FRESHNESS_CLOCK = datetime(2001, 12, 1, 0, 0, 30)


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return current_rows(fixtures.changes(spark, sf, "orders"))


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return current_rows(fixtures.changes(spark, sf, "customers"))


def _products(spark: SparkSession, sf: str) -> DataFrame:
    return current_rows(fixtures.changes(spark, sf, "products"))


def _live_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "orders": _orders(spark, sf),
        "customers": _customers(spark, sf),
        "products": _products(spark, sf),
    }


def _logs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {n: fixtures.changes(spark, sf, n) for n in ("customers", "products", "orders")}


def _topics(spark: SparkSession, sf: str) -> DataFrame:
    names = ("customers", "products", "orders")
    return events.all_topics(*(fixtures.topic(spark, sf, n) for n in names))


def _order_clock(orders: DataFrame):
    return fixtures.latest_micros(orders, "order_time")


def _shown(rows: DataFrame, *times: str) -> DataFrame:
    """Epoch-microsecond columns as timestamps."""
    return rows.withColumns({c: utc_timestamp(F.col(c)) for c in times})


# -- decode and flatten ---------------------------------------------------


def cdc_decode_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The topic written to a folder, read back as a batch and decoded in full."""
    folder = new_run_folder(spark, "topic-orders")
    fixtures.topic(spark, sf, "orders").write.parquet(folder)
    parsed = decode(read_topic_folder(spark, folder), fixtures.WIDE_ORDERS)
    value = F.col("value_json")
    return parsed.select(
        "topic",
        F.col("key_json.id").alias("key_id"),
        value["op"].alias("op"),
        value["ts_ms"].alias("ts_ms"),
        value["source"]["table"].alias("source_table"),
        value["before"]["id"].alias("before_id"),
        value["before"]["quantity"].alias("before_quantity"),
        value["after"]["id"].alias("after_id"),
        value["after"]["customer_id"].alias("after_customer_id"),
        value["after"]["product_id"].alias("after_product_id"),
        value["after"]["quantity"].alias("after_quantity"),
        value["after"]["order_time"].alias("after_order_time"),
    )


def _flatten(name: str, include_op: bool = False) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        spec = fixtures.SPECS[name]
        parsed = decode(fixtures.topic(spark, sf, name), spec, narrow=True)
        return change_ops.flatten(parsed, spec, include_op)

    return query


def cdc_flatten_debug(spark: SparkSession, sf: str) -> DataFrame:
    """All three tables' debug rows, on the columns they share."""
    shared = ["id", "_version", "_deleted", "operation", "processing_version"]
    parts = []
    for name in ("customers", "products", "orders"):
        rows = change_ops.add_processing_metadata(_flatten(name, include_op=True)(spark, sf))
        parts.append(rows.select(F.lit(name).alias("table_name"), *shared))
    return events.all_topics(*parts)


def cdc_valid(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.faulty_topic(spark, sf, "orders")
    return change_ops.valid_changes(rows, fixtures.WIDE_ORDERS)


def cdc_quarantine_counts(spark: SparkSession, sf: str) -> DataFrame:
    parts = []
    for name in ("customers", "products", "orders"):
        rows = fixtures.faulty_topic(spark, sf, name)
        bad = change_ops.quarantined(rows, fixtures.SPECS[name])
        counts = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"))
        parts.append(counts.select(F.lit(name).alias("table_name"), "reason", "rejected"))
    return events.all_topics(*parts)


def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Departures of all three topics from their schemas."""
    parts = [drift(fixtures.drifted_topic(spark, sf, n), spec) for n, spec in fixtures.SPECS.items()]
    return events.all_topics(*parts)


def decimal_decode(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(10,2)")
    coded = fixtures.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), encode_decimal(price).alias("raw_price")
    )
    return coded.withColumn("price", decode_decimal(F.col("raw_price"), 10, 2))


def utf8_decode(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.event_topic(spark, sf)
    return rows.select(F.col("offset").alias("event_id"), utf8_text(F.col("key")).alias("key_text"))


def events_props_json(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.table(spark, sf, "events")
    return rows.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


def safe_cast_props(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.table(spark, sf, "events")
    text = F.when(F.col("event_id") % 10 == 0, F.col("event_type")).otherwise(
        F.get_json_object("props", "$.k")
    )
    return rows.select("event_id", safe_cast(text, "int", -1).alias("k"))


# -- state ----------------------------------------------------------------


def current_orders(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("id", "customer_id", "product_id", "quantity", "order_time")
    return _shown(_orders(spark, sf).select(*columns), "order_time")


def current_customers(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("id", "name", "email", "created_at")
    return _shown(_customers(spark, sf).select(*columns), "created_at")


def snapshot_merge_customers(spark: SparkSession, sf: str) -> DataFrame:
    """An initial snapshot of the whole table, then the live changes over it.

    One market segment has not changed since, so its snapshot rows survive.
    """
    table = fixtures.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("bigint").alias("created_at"),
    )
    taken = change_ops.snapshot_changes(table, fixtures.WIDE_CUSTOMERS, taken_at_ms=0)
    still = fixtures.table(spark, sf, "customer").filter("c_mktsegment = 'FURNITURE'")
    later = fixtures.changes(spark, sf, "customers").join(
        still.select(F.col("c_custkey").alias("id")), "id", "left_anti"
    )
    log = taken.unionByName(later)
    columns = ("id", "name", "email", "created_at")
    return _shown(current_rows(log).select(*columns), "created_at")


def snapshot_chunks_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Live orders from a snapshot in four chunks, each read at another time, and the changes since the first.

    The source at a time is what the changes up to it amount to.
    """
    spec, log = fixtures.WIDE_ORDERS, fixtures.changes(spark, sf, "orders")
    bounds = key_bounds(log.select("id"), 4)
    times = log.agg(F.approx_percentile("_version", [0.2, 0.35, 0.5, 0.65])).first()[0]
    margin = 5 * 86_400_000
    chunks = []
    for n, at in enumerate(times):
        source = current_rows(log.filter(F.col("_version") <= at))
        chunk = source.filter(range_of(F.col("id"), bounds) == n)
        chunks.append(settled_chunk(chunk, log, spec, at - margin, at + margin))
    since = log.filter(F.col("_version") > times[0] - margin)
    columns = ("id", "customer_id", "product_id", "quantity", "order_time")
    return _shown(current_rows(events.all_topics(since, *chunks)).select(*columns), "order_time")


def order_key_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Sixteen key ranges over ids of which most lie close together: rows, ranges, and whether none is large."""
    near = F.when(F.col("id") % 10 == 0, F.col("id") * 1000).otherwise(F.col("id"))
    rows = fixtures.changes(spark, sf, "orders").select("id").distinct().select(near.alias("id"))
    bounds = key_bounds(rows, 16)
    sizes = rows.groupBy(range_of(F.col("id"), bounds).alias("range")).agg(F.count(F.lit(1)).alias("n"))
    even = F.max("n") <= 2 * F.sum("n") / F.count(F.lit(1))
    return sizes.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("ranges"), even.alias("even"))


def current_products(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("id", "name", "price", "created_at")
    return _shown(_products(spark, sf).select(*columns), "created_at")


def _order_state(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", "customer_id", "product_id", "quantity", "order_time", "_version", "_deleted"
    )


def merge_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """State of the older half of the log, with the newer half folded in."""
    rows = fixtures.changes(spark, sf, "orders")
    middle = rows.agg(F.avg("_version")).scalar()
    state = latest_versions(rows.filter(F.col("_version") <= middle))
    return _order_state(merge_changes(state, rows.filter(F.col("_version") > middle)))


def _kept_orders(spark: SparkSession, sf: str) -> ChangeLog:
    """Three log batches, compacted after the second."""
    root = new_run_folder(spark, "compact")
    changelog = ChangeLog(spark, f"{root}/orders", fixtures.WIDE_ORDERS, buckets=8)
    no_fault = {c: F.lit(None).cast("string") for c in ("reason", "key_text", "value_text")}
    rows = fixtures.changes(spark, sf, "orders").withColumns(no_fault)
    part = F.pmod(F.xxhash64("offset", "id"), F.lit(3))
    for batch_id in range(3):
        changelog.write_batch(rows.filter(part == batch_id), batch_id)
        if batch_id == 1:
            changelog.compact(through={1: 1})
    return changelog


def compact_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The state of all three batches: that of two, and the third laid over it."""
    return _order_state(_kept_orders(spark, sf).state())


def _pinned_clock(changelog: ChangeLog):
    """Time of the newest live order, one number, as a literal that reaches the scan."""
    return F.lit(changelog.newest()).cast("bigint")


# -- streams --------------------------------------------------------------


def _third_of_files(spark: SparkSession, folder: str) -> int:
    """So many files a batch that the batches do not grow in number with the input."""
    return max(1, -(-len(spark.read.parquet(folder).inputFiles()) // 3))


def _staged_stream(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """Topic rows written out as files and read back as a stream of about three batches."""
    rows.write.parquet(folder)
    return read_topic_folder_stream(spark, folder, files_per_trigger=_third_of_files(spark, folder))


def stream_orders_log(spark: SparkSession, sf: str) -> DataFrame:
    """Orders topic through the streaming job; the log it leaves."""
    root = new_run_folder(spark, "stream-orders")
    source = _staged_stream(spark, fixtures.topic(spark, sf, "orders"), f"{root}/topic")
    changelog = ChangeLog(spark, f"{root}/orders", fixtures.WIDE_ORDERS)
    query = start_table(
        source,
        fixtures.WIDE_ORDERS,
        log_writer(changelog, ckpt=1),
        f"{root}/checkpoints/orders/v1",
        PipelineConfig(),
        available_now=True,
    )
    query.awaitTermination()
    return _order_state(changelog.changes())


def stream_all_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All three tables at once, with 64-bit ids; the live rows of each afterwards."""
    root = new_run_folder(spark, "stream-all")
    sources = {
        n: _staged_stream(spark, fixtures.topic(spark, sf, n), f"{root}/topics/{n}")
        for n in ("customers", "products", "orders")
    }
    runs = run_tables(spark, sources, root, PipelineConfig(long_ids=True), available_now=True)
    finish(runs)
    details = {
        "customers": ("created_at", F.col("name")),
        "products": ("created_at", F.col("price").cast("string")),
        "orders": ("order_time", F.concat_ws(" ", "customer_id", "product_id", "quantity")),
    }
    return events.all_topics(
        *(
            runs[n].changelog.current().select(
                F.lit(n).alias("table_name"), "id", F.col(at).alias("event_us"), detail.alias("detail")
            )
            for n, (at, detail) in details.items()
        )
    )


def _feed(spark: SparkSession, sf: str, root: str, name: str = "orders") -> DataFrame:
    """A table's topic through the retraction job; its feed as a stream of a few batches."""
    let_workers_import(spark)
    source = _staged_stream(spark, fixtures.topic(spark, sf, name), f"{root}/topics/{name}")
    spec, feed = fixtures.SPECS[name], f"{root}/feeds/{name}"
    checkpoint = f"{root}/checkpoints/feeds/{name}"
    start_feed(source, spec, feed, checkpoint, PipelineConfig(), available_now=True).awaitTermination()
    return read_feed(spark, feed, spec, files_per_trigger=_third_of_files(spark, feed))


def stream_daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sales kept from the retractions of the stream of order changes."""
    root = new_run_folder(spark, "stream-daily")
    feed = _feed(spark, sf, root)
    query = start_daily_sales(feed, f"{root}/daily", f"{root}/checkpoints/daily", PipelineConfig(), available_now=True)
    query.awaitTermination()
    return read_daily_sales(spark, f"{root}/daily")


def stream_hourly_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Hours of the last day, from event-time windows over the retractions of the stream."""
    root = new_run_folder(spark, "stream-hourly")
    feed = _feed(spark, sf, root)
    path = f"{root}/minutes"
    start_hourly_orders(feed, path, f"{root}/checkpoints/hourly", PipelineConfig(), available_now=True).awaitTermination()
    newest = recent_minutes(spark, path).agg(F.max("start_us")).scalar()
    return read_hourly_orders(spark, path, newest)


def stream_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Parents that are missing and how many live orders refer to them, kept from three feeds."""
    root = new_run_folder(spark, "stream-orphans")
    parents = {n: (c, _feed(spark, sf, root, n)) for n, c in (("customers", "customer_id"), ("products", "product_id"))}
    rows = references(_feed(spark, sf, root), parents)
    path = f"{root}/orphans"
    start_orphans(rows, path, f"{root}/checkpoints/orphans", PipelineConfig(), available_now=True).awaitTermination()
    return read_orphans(spark, path)


def stream_top_customers(spark: SparkSession, sf: str) -> DataFrame:
    """The fifty customers with most orders, kept from the feeds of orders and customers."""
    root = new_run_folder(spark, "stream-leaders")
    rows = references(_feed(spark, sf, root), {"customers": ("customer_id", _feed(spark, sf, root, "customers"))})
    path = f"{root}/leaders"
    start_leaders(rows, path, f"{root}/checkpoints/leaders", PipelineConfig(), available_now=True).awaitTermination()
    return read_leaders(spark, path).withColumnRenamed("id", "customer_id")


def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """What the job over a topic with faults and repeated deliveries reported, per table."""
    root = new_run_folder(spark, "stream-progress")
    table = ProgressTable(spark, f"{root}/progress")
    spark.streams.addListener(table)
    try:
        names = {}
        for name in ("customers", "products"):
            rows = fixtures.faulty_topic(spark, sf, name)
            rows.write.parquet(f"{root}/topics/{name}/0")
            files = _third_of_files(spark, f"{root}/topics/{name}/0")
            source = read_topic_folder_stream(spark, f"{root}/topics/{name}/*", files_per_trigger=files)
            again = rows.filter("offset % 7 = 0")  # delivered once more, in a later batch
            again.write.parquet(f"{root}/topics/{name}/1")
            changelog = ChangeLog(spark, f"{root}/{name}", fixtures.SPECS[name], buckets=8)
            config = PipelineConfig(repeats_within="1 hour")
            query = start_table(
                source, fixtures.SPECS[name], log_writer(changelog, 1), f"{root}/checkpoints/{name}", config, available_now=True
            )
            query.awaitTermination()
            table.wait_for(query.runId)
            names[str(query.id)] = name
    finally:
        spark.streams.removeListener(table)
    label = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))[F.col("query_id")]
    return throughput(read_progress(spark, table.path)).select(label.alias("table_name"), "rows", "rejected")


# -- sales ----------------------------------------------------------------


def daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    return sales.daily_sales(_orders(spark, sf))


def daily_sales_30d(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf)
    return sales.daily_sales_since(orders, _order_clock(orders))


def monthly_sales(spark: SparkSession, sf: str) -> DataFrame:
    return sales.monthly_sales(_orders(spark, sf))


def hourly_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf)
    return sales.hourly_orders(orders, _order_clock(orders))


def daily_sales_30d_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The last 30 days from the folded state and the batches after it."""
    changelog = _kept_orders(spark, sf)
    clock = _pinned_clock(changelog)
    recent = changelog.recent(day_start(clock) - 30 * MICROS_PER_DAY)
    return sales.daily_sales_since(recent, clock)


def hourly_orders_kept(spark: SparkSession, sf: str) -> DataFrame:
    changelog = _kept_orders(spark, sf)
    clock = _pinned_clock(changelog)
    return sales.hourly_orders(changelog.recent(clock - MICROS_PER_DAY), clock)


def hourly_panel(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf)
    return sales.hourly_panel(orders, _order_clock(orders))


def daily_rollup(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf)
    path = new_run_folder(spark, "rollup")
    roll_yesterday(orders, path, _order_clock(orders))
    return read_rollup(spark, path)


def daily_rollup_read(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_folder(spark, "rollup")
    rebuild_rollup(_orders(spark, sf), path)
    return read_rollup(spark, path)


def _kept_uniques(spark: SparkSession, sf: str) -> DataFrame:
    """Bitmaps of all days, of the last one without some products at first; then that day done anew."""
    orders = _orders(spark, sf)
    path = new_run_folder(spark, "uniques")
    clock = _order_clock(orders)
    first = F.pmod(F.col("product_id"), F.lit(5)) != 0
    old_day = (F.col("order_time") >= day_start(clock)) & ~first
    uniques.rebuild_uniques(orders.filter(~old_day), path)
    uniques.roll_uniques(orders, path, clock + MICROS_PER_DAY)
    return uniques.read_uniques(spark, path)


def monthly_uniques_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct customers and products of each month, from kept bitmaps of its days."""
    month = F.year("date") * 100 + F.month("date")
    return uniques.unique_counts(uniques.merged(_kept_uniques(spark, sf), month)).withColumnRenamed("period", "month")


def weekly_uniques_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the week that begins on a Monday."""
    week = F.trunc("date", "week")
    return uniques.unique_counts(uniques.merged(_kept_uniques(spark, sf), week)).withColumnRenamed("period", "week")


# -- customers and products -----------------------------------------------


def customer_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return customers.customer_metrics(_customers(spark, sf), _orders(spark, sf))


def product_performance(spark: SparkSession, sf: str) -> DataFrame:
    return products.product_performance(_products(spark, sf), _orders(spark, sf))


def registration_trend(spark: SparkSession, sf: str) -> DataFrame:
    rows = _customers(spark, sf)
    return customers.registration_trend(rows, fixtures.latest_micros(rows, "created_at"))


def customer_overview(spark: SparkSession, sf: str) -> DataFrame:
    rows = _customers(spark, sf)
    clock = fixtures.latest_micros(rows, "created_at")
    return customers.customer_overview(rows, _orders(spark, sf), clock)


# -- health and events ----------------------------------------------------


def recent_activity(spark: SparkSession, sf: str) -> DataFrame:
    t = _live_tables(spark, sf)
    return health.recent_activity(t["orders"], t["customers"], t["products"])


def record_counts_panel(spark: SparkSession, sf: str) -> DataFrame:
    return recent_activity(spark, sf).select("activity_type", "total_records")


def recent_activity_24h(spark: SparkSession, sf: str) -> DataFrame:
    """The view as its label reads: only rows of the 24 hours before the newest order."""
    t = _live_tables(spark, sf)
    since = _order_clock(t["orders"]) - MICROS_PER_DAY
    return health.recent_activity(t["orders"], t["customers"], t["products"], since)


def recent_activity_24h_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The last 24 hours, orders from the kept state."""
    changelog = _kept_orders(spark, sf)
    since = _pinned_clock(changelog) - MICROS_PER_DAY
    orders = changelog.recent(since)
    return health.recent_activity(orders, _customers(spark, sf), _products(spark, sf), since)


def data_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return health.data_freshness(_logs(spark, sf), FRESHNESS_CLOCK)


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return health.table_counts(_live_tables(spark, sf))


def event_preview(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.event_topic(spark, sf)
    clock = rows.agg(F.max(F.unix_micros("timestamp"))).scalar()
    return events.preview(rows, limit=10, as_of=clock, minutes=5)


def event_preview_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Newest messages of two of the three change topics, at the pinned clock."""
    return events.preview(
        _topics(spark, sf),
        limit=10,
        as_of=FRESHNESS_CLOCK,
        topics=["pg.public.customers", "pg.public.products"],
    )


def event_poll(spark: SparkSession, sf: str) -> DataFrame:
    """The last ten messages of every partition of the change topics."""
    rows = events.newest_per_partition(_topics(spark, sf), 10)
    return rows.select("topic", "partition", "offset", utf8_text(F.col("key")).alias("key"))


def event_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Every message whose operation is an update."""
    rows = events.of_operation(_topics(spark, sf), "u")
    return rows.select("topic", "partition", "offset", utf8_text(F.col("key")).alias("key"))


def event_summary(spark: SparkSession, sf: str) -> DataFrame:
    return events.summary(_topics(spark, sf))


def event_counts_by_table(spark: SparkSession, sf: str) -> DataFrame:
    return events.counts_by_table(_topics(spark, sf))


def event_counts_by_op(spark: SparkSession, sf: str) -> DataFrame:
    return events.counts_by_op(_topics(spark, sf))


# -- joins ----------------------------------------------------------------


def orders_enriched(spark: SparkSession, sf: str) -> DataFrame:
    t = _live_tables(spark, sf)
    return joins.enrich_orders(t["orders"], t["customers"], t["products"])


def enriched_by_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched orders of the older half of each log, brought up to date by the delta of the newer half."""
    root, tables = new_run_folder(spark, "deltas"), []

    def staged(rows: DataFrame, folder: str) -> DataFrame:
        """Written once, as the parts of the join each start from it."""
        rows.write.parquet(f"{root}/{folder}")
        return spark.read.schema(rows.schema).parquet(f"{root}/{folder}")

    for name in ("orders", "customers", "products"):
        log = staged(fixtures.changes(spark, sf, name), f"{name}/log")
        middle = log.agg(F.avg("_version")).scalar()
        before = staged(latest_versions(log.filter(F.col("_version") <= middle)), f"{name}/before")
        delta = staged(table_delta(before, log.filter(F.col("_version") > middle)), f"{name}/delta")
        tables.append((live(before), delta))
    return applied(joins.enrich_orders(*(rows for rows, _ in tables)), enriched_delta(*tables))


def recent_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = ranking.top(orders_enriched(spark, sf), "order_time", "id", 10)
    return rows.drop("total_amount")


def customers_without_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = joins.without_orders(_customers(spark, sf), _orders(spark, sf), "customer_id")
    return rows.select("id", "name", "email")


def products_without_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = joins.without_orders(_products(spark, sf), _orders(spark, sf), "product_id")
    return rows.select("id", "name", "price")


def delete_candidates(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf)
    buyers = joins.delete_candidates(_customers(spark, sf), orders, "customer_id", 3)
    items = joins.delete_candidates(_products(spark, sf), orders, "product_id", 2)
    return buyers.select(F.lit("customers").alias("table_name"), "id", "name").unionByName(
        items.select(F.lit("products").alias("table_name"), "id", "name")
    )


def deletable_customers(spark: SparkSession, sf: str) -> DataFrame:
    return joins.deletable(_customers(spark, sf), _orders(spark, sf), "customer_id")


def deletable_products(spark: SparkSession, sf: str) -> DataFrame:
    return joins.deletable(_products(spark, sf), _orders(spark, sf), "product_id")


def snapshot_customers(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshot_in_order(_customers(spark, sf))
    return _shown(rows.select("id", "name", "email", "created_at"), "created_at")


def sample_customers(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.random_rows(_customers(spark, sf), 5, seed=42).select("id", "name")


# -- quality --------------------------------------------------------------


def dq_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Live orders of which every hundredth is delivered twice."""
    rows = _orders(spark, sf).select("id")
    return quality.duplicates(rows.unionByName(rows.filter("id % 100 = 3")), "id")


def dq_null_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Changes that are not deletes, of which some lost an address or a quantity."""
    kept = {n: r.filter("_deleted = 0") for n, r in _logs(spark, sf).items()}
    for name, column, every in (("customers", "email", 10), ("orders", "quantity", 100)):
        lost = F.when(F.col("id") % every != 3, F.col(column))
        kept[name] = kept[name].withColumn(column, lost)
    return quality.null_counts({n: (r, fixtures.SPECS[n]) for n, r in kept.items()})


def dq_duplicate_emails(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth customer is given the address of the next lower id."""
    rows = fixtures.changes(spark, sf, "customers").filter(F.col("_deleted") == 0)
    copied = F.format_string("customer.%09d@example.com", F.col("id") - 1)
    email = F.when(F.col("id") % 10 == 3, copied).otherwise(F.col("email"))
    return quality.duplicates(rows.withColumn("email", email), "email")


def dq_orphan_orders(spark: SparkSession, sf: str) -> DataFrame:
    t = _live_tables(spark, sf)
    return quality.orphans(
        t["orders"],
        {
            "customers": ("customer_id", t["customers"]),
            "products": ("product_id", t["products"]),
        },
    )


_QUERIES: dict[str, Query] = {
    "cdc_decode_orders": cdc_decode_orders,
    "cdc_flatten_customers": _flatten("customers"),
    "cdc_flatten_orders": _flatten("orders"),
    "cdc_flatten_products": _flatten("products"),
    "cdc_flatten_debug": cdc_flatten_debug,
    "cdc_valid": cdc_valid,
    "cdc_quarantine_counts": cdc_quarantine_counts,
    "schema_drift": schema_drift,
    "decimal_decode": decimal_decode,
    "utf8_decode": utf8_decode,
    "events_props_json": events_props_json,
    "safe_cast_props": safe_cast_props,
    "current_orders": current_orders,
    "current_customers": current_customers,
    "current_products": current_products,
    "snapshot_merge_customers": snapshot_merge_customers,
    "snapshot_chunks_orders": snapshot_chunks_orders,
    "order_key_ranges": order_key_ranges,
    "merge_incremental": merge_incremental,
    "compact_orders": compact_orders,
    "stream_orders_log": stream_orders_log,
    "stream_all_tables": stream_all_tables,
    "stream_daily_sales": stream_daily_sales,
    "stream_hourly_orders": stream_hourly_orders,
    "stream_progress": stream_progress,
    "stream_orphans": stream_orphans,
    "stream_top_customers": stream_top_customers,
    "daily_sales": daily_sales,
    "daily_sales_30d": daily_sales_30d,
    "daily_sales_30d_kept": daily_sales_30d_kept,
    "monthly_sales": monthly_sales,
    "hourly_orders": hourly_orders,
    "hourly_orders_kept": hourly_orders_kept,
    "hourly_panel": hourly_panel,
    "daily_rollup": daily_rollup,
    "daily_rollup_read": daily_rollup_read,
    "monthly_uniques_kept": monthly_uniques_kept,
    "weekly_uniques_kept": weekly_uniques_kept,
    "customer_metrics": customer_metrics,
    "top_customers": lambda s, d: customers.top_customers(customer_metrics(s, d)),
    "top_customers_10": lambda s, d: customers.top_customers_panel(customer_metrics(s, d)),
    "vip_customers": lambda s, d: customers.vip_customers(customer_metrics(s, d)),
    "order_count_histogram": lambda s, d: customers.order_count_histogram(customer_metrics(s, d)),
    "registration_trend": registration_trend,
    "customer_overview": customer_overview,
    "product_performance": product_performance,
    "top_products": lambda s, d: products.top_products(product_performance(s, d)),
    "top_products_10": lambda s, d: products.top_products_panel(product_performance(s, d)),
    "recent_activity": recent_activity,
    "recent_activity_24h": recent_activity_24h,
    "recent_activity_24h_kept": recent_activity_24h_kept,
    "record_counts_panel": record_counts_panel,
    "data_freshness": data_freshness,
    "table_counts": table_counts,
    "event_preview": event_preview,
    "event_preview_topics": event_preview_topics,
    "event_poll": event_poll,
    "event_updates": event_updates,
    "event_summary": event_summary,
    "event_counts_by_table": event_counts_by_table,
    "event_counts_by_op": event_counts_by_op,
    "orders_enriched": orders_enriched,
    "enriched_by_deltas": enriched_by_deltas,
    "recent_orders": recent_orders,
    "customers_without_orders": customers_without_orders,
    "products_without_orders": products_without_orders,
    "delete_candidates": delete_candidates,
    "deletable_customers": deletable_customers,
    "deletable_products": deletable_products,
    "snapshot_customers": snapshot_customers,
    "sample_customers": sample_customers,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_null_counts": dq_null_counts,
    "dq_duplicate_emails": dq_duplicate_emails,
    "dq_orphan_orders": dq_orphan_orders,
}


def entry(spark: SparkSession) -> DataFrame:
    """Daily sales of the live orders, from the smallest tables."""
    return daily_sales(spark, "/root/testdata/sf0.001")


def core_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _llm_queries() -> dict[str, Query]:
    if llm_entries is None:
        return {}
    return {**llm_entries.QUERIES, "pipeline": corpus_pipeline.run}


def queries() -> dict[str, Query]:
    return {**_QUERIES, **_llm_queries()}


def oracle_sql() -> dict[str, str]:
    return {**oracles.all_sql(), **(llm_entries.ORACLE_SQL if llm_entries else {})}
