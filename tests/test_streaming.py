from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from rows import bag, envelope, message, order, topic

from tidemark import fixtures
from tidemark.config import JdbcTarget, PipelineConfig
from tidemark.functions.times import MICROS_PER_DAY
from tidemark.operators.changes import valid_changes
from tidemark.operators.state import current_rows
from tidemark.plans.sales import daily_sales, hourly_orders
from tidemark.schemas import ORDERS
from tidemark.sinks.changelog import ChangeLog
from tidemark.session import let_workers_import
from tidemark.sources.kafka import read_topic_folder, read_topic_folder_stream
from tidemark.streaming.jobs import (
    finish,
    log_writer,
    run_tables,
    start_debug,
    start_table,
    status,
    stop,
)
from tidemark.streaming.metrics import read_daily_sales, start_daily_sales
from tidemark.streaming.progress import ProgressTable, read_progress, throughput
from tidemark.streaming.retractions import net_rows, read_feed, start_feed
from tidemark.streaming.windows import read_hourly_orders, start_hourly_orders

CONFIG = PipelineConfig()


def put(spark, folder, *messages):
    """Append one file of messages to a topic folder."""
    topic(spark, *messages).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, write, checkpoint, spec=ORDERS, files=1):
    source = read_topic_folder_stream(spark, folder, files_per_trigger=files)
    query = start_table(source, spec, write, checkpoint, CONFIG, available_now=True)
    query.awaitTermination()
    return query


def created(id, offset, ts_ms=1, **columns):
    return message(envelope("c", after=order(id, **columns), ts_ms=ts_ms), offset=offset)


def deleted(id, offset, ts_ms=1):
    return message(envelope("d", before=order(id), ts_ms=ts_ms), offset=offset)


def test_stream_equals_batch_over_many_batches(spark, small, tmp_path):
    folder = str(tmp_path / "topic")
    fixtures.topic(spark, small, "orders").repartition(4).write.parquet(folder)
    changelog = ChangeLog(spark, str(tmp_path / "log"), fixtures.WIDE_ORDERS)
    run(spark, folder, log_writer(changelog, 1), str(tmp_path / "ckpt"), fixtures.WIDE_ORDERS)
    assert changelog.batches() == {1: 3}
    batch = valid_changes(read_topic_folder(spark, folder), fixtures.WIDE_ORDERS)
    assert bag(changelog.changes()) == bag(batch)
    assert bag(changelog.current()) == bag(current_rows(batch))


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    folder, ckpt = str(tmp_path / "topic"), str(tmp_path / "ckpt")
    changelog = ChangeLog(spark, str(tmp_path / "log"), ORDERS)
    put(spark, folder, created(1, 1))
    run(spark, folder, log_writer(changelog, 1), ckpt)
    put(spark, folder, created(2, 2), deleted(1, 3, ts_ms=2))
    run(spark, folder, log_writer(changelog, 1), ckpt)
    assert changelog.changes().count() == 3
    assert [r["id"] for r in changelog.current().collect()] == [2]


def test_a_batch_that_fails_after_its_write_is_not_doubled(spark, tmp_path):
    folder, ckpt = str(tmp_path / "topic"), str(tmp_path / "ckpt")
    changelog = ChangeLog(spark, str(tmp_path / "log"), ORDERS)
    put(spark, folder, created(1, 1))
    put(spark, folder, created(2, 2))
    real = log_writer(changelog, 1)

    def dies_after_batch_one(batch, batch_id):
        real(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(spark, folder, dies_after_batch_one, ckpt)
    run(spark, folder, real, ckpt)
    assert sorted(r["id"] for r in changelog.changes().collect()) == [1, 2]


def test_a_new_checkpoint_version_replays_without_changing_the_state(spark, tmp_path):
    folder = str(tmp_path / "topic")
    changelog = ChangeLog(spark, str(tmp_path / "log"), ORDERS)
    put(spark, folder, created(1, 1, quantity=1), created(1, 2, ts_ms=5, quantity=2))
    run(spark, folder, log_writer(changelog, 1), str(tmp_path / "v1"))
    before = bag(changelog.state())
    run(spark, folder, log_writer(changelog, 2), str(tmp_path / "v2"))
    assert changelog.changes().count() == 4
    assert bag(changelog.state()) == before


def test_late_and_repeated_changes(spark, tmp_path):
    folder = str(tmp_path / "topic")
    changelog = ChangeLog(spark, str(tmp_path / "log"), ORDERS)
    put(spark, folder, created(1, 2, ts_ms=11, quantity=2))
    put(spark, folder, created(1, 1, ts_ms=10, quantity=1), created(1, 2, ts_ms=11, quantity=2))
    run(spark, folder, log_writer(changelog, 1), str(tmp_path / "ckpt"))
    assert [r["quantity"] for r in changelog.current().collect()] == [2]


def test_row_counts_are_observed(spark, tmp_path):
    folder = str(tmp_path / "topic")
    changelog = ChangeLog(spark, str(tmp_path / "log"), ORDERS)
    put(spark, folder, created(1, 1), message("x", offset=2), message(None, offset=3))
    query = run(spark, folder, log_writer(changelog, 1), str(tmp_path / "ckpt"))
    seen = [p["observedMetrics"]["changes"] for p in query.recentProgress if p["numInputRows"]]
    assert [(m["rows"], m["rejected"]) for m in seen] == [(3, 2)]


def test_all_tables_in_one_session(spark, small, tmp_path):
    sources = {}
    for name in ("customers", "products"):
        folder = str(tmp_path / "topics" / name)
        fixtures.topic(spark, small, name).write.parquet(folder)
        sources[name] = read_topic_folder_stream(spark, folder)
    runs = run_tables(spark, sources, str(tmp_path / "root"), CONFIG, available_now=True)
    finish(runs)
    for name, done in runs.items():
        want = current_rows(fixtures.changes(spark, small, name))
        assert bag(done.changelog.current()) == bag(want)
        assert (tmp_path / "root" / "checkpoints" / name / "v1" / "commits").exists()


def test_wide_ids_pass_the_runner_if_asked_for(spark, tmp_path):
    folder = str(tmp_path / "topic")
    wide = 3_000_000_001
    put(spark, folder, message(envelope("c", order(wide)), key=f'{{"id": {wide}}}'))
    for long_ids, found in ((True, [wide]), (False, [])):
        sources = {"orders": read_topic_folder_stream(spark, folder)}
        config = replace(CONFIG, long_ids=long_ids)
        runs = run_tables(spark, sources, str(tmp_path / str(long_ids)), config, available_now=True)
        finish(runs)
        assert [r["id"] for r in runs["orders"].changelog.current().collect()] == found


def test_the_runner_folds_its_logs(spark, tmp_path):
    folder = str(tmp_path / "topic")
    for n in range(4):
        put(spark, folder, created(n, n))
    source = read_topic_folder_stream(spark, folder, files_per_trigger=1)
    config = replace(CONFIG, compact_every=2, drop_folded=True, tombstone_days=7)
    runs = run_tables(spark, {"orders": source}, str(tmp_path / "root"), config, available_now=True)
    finish(runs)
    changelog = runs["orders"].changelog
    number, folded = changelog.folded()
    assert number == 2 and folded == {1: changelog.batches()[1] - 1} and changelog.batches() == {1: 3}
    assert changelog.current().count() == len({r["id"] for r in changelog.current().collect()}) > 0


def test_jdbc_sink_gets_the_valid_changes(spark, tmp_path, monkeypatch):
    """The writer is replaced: no database is at hand."""
    written = []

    def keep(rows, target, table):
        written.append((target.url, table, rows.columns, [r["id"] for r in rows.collect()]))

    monkeypatch.setattr("tidemark.streaming.jobs.write_table", keep)
    folder = str(tmp_path / "topic")
    put(spark, folder, created(1, 1), message("x", offset=2))
    sources = {"orders": read_topic_folder_stream(spark, folder)}
    config = replace(CONFIG, sink="jdbc", jdbc=JdbcTarget(url="jdbc:x:y", driver="d"))
    runs = run_tables(spark, sources, str(tmp_path / "root"), config, available_now=True)
    finish(runs)
    columns = [*ORDERS.columns, "_version", "_deleted"]
    assert written == [("jdbc:x:y", "orders_cdc", ["id", *columns], [1])]
    assert runs["orders"].changelog is None


def test_debug_rows_reach_the_sink(spark, tmp_path):
    folder = str(tmp_path / "topic")
    put(spark, folder, created(1, 1), message("x", offset=2))
    source = read_topic_folder_stream(spark, folder)
    query = start_debug(source, ORDERS, CONFIG, sink="memory", available_now=True)
    query.awaitTermination()
    rows = spark.table("orders_debug").collect()
    assert [(r["id"], r["operation"], r["processing_version"]) for r in rows] == [(1, "c", "1.0")]


def test_status_and_stop(spark, tmp_path):
    folder = str(tmp_path / "topic")
    put(spark, folder, created(1, 1))
    sources = {"orders": read_topic_folder_stream(spark, folder)}
    config = replace(CONFIG, trigger_interval="1 second")
    runs = run_tables(spark, sources, str(tmp_path / "root"), config)
    try:
        runs["orders"].query.processAllAvailable()
        mine = [s for s in status(spark) if s["id"] == str(runs["orders"].query.id)]
        assert len(mine) == 1 and mine[0]["active"]
    finally:
        stop(runs)
    assert not runs["orders"].query.isActive
    assert runs["orders"].changelog.changes().count() == 1


def feed_of(spark, folder, checkpoint, feed, spec=ORDERS):
    source = read_topic_folder_stream(spark, folder, files_per_trigger=1)
    start_feed(source, spec, feed, checkpoint, CONFIG, available_now=True).awaitTermination()


def daily_of(spark, feed, checkpoint, daily, spec=ORDERS, files=1):
    stream = read_feed(spark, feed, spec, files_per_trigger=files)
    start_daily_sales(stream, daily, checkpoint, CONFIG, available_now=True).awaitTermination()
    return read_daily_sales(spark, daily)


def test_streamed_daily_sales_equal_the_batch_view(spark, small, tmp_path):
    let_workers_import(spark)
    folder, feed, daily = (str(tmp_path / n) for n in ("topic", "feed", "daily"))
    rows = fixtures.topic(spark, small, "orders").repartition(3, "offset")
    rows.write.parquet(folder)
    feed_of(spark, folder, str(tmp_path / "c1"), feed, fixtures.WIDE_ORDERS)
    live = current_rows(fixtures.changes(spark, small, "orders"))
    columns = ["id", *ORDERS.columns]
    assert bag(net_rows(spark.read.parquet(feed), fixtures.WIDE_ORDERS)) == bag(live.select(columns))
    got = daily_of(spark, feed, str(tmp_path / "c2"), daily, fixtures.WIDE_ORDERS, files=8)
    assert bag(got) == bag(daily_sales(live))


def test_orders_that_move_repeat_come_late_or_go(spark, tmp_path):
    let_workers_import(spark)
    folder, feed, daily = (str(tmp_path / n) for n in ("topic", "feed", "daily"))
    day = MICROS_PER_DAY

    def figures():
        feed_of(spark, folder, str(tmp_path / "c1"), feed)
        rows = daily_of(spark, feed, str(tmp_path / "c2"), daily, files=100).collect()
        changes = valid_changes(read_topic_folder(spark, folder), ORDERS)
        assert sorted(map(tuple, rows), key=repr) == bag(daily_sales(current_rows(changes)))
        return {str(r["date"]): r["total_orders"] for r in rows}

    put(spark, folder, created(1, 1, order_time=0), created(2, 2, order_time=0, customer_id=None, quantity=None))
    put(spark, folder, created(3, 3, order_time=9 * day), created(4, 4, order_time=None), message("not json", offset=9))
    assert figures() == {"1970-01-01": 2, "1970-01-10": 1, "None": 1}
    # order 1 moves, order 3 goes; 2 comes again and later than a newer change of it
    put(spark, folder, created(1, 5, ts_ms=5, order_time=day), deleted(3, 6, ts_ms=5), created(2, 7, ts_ms=9, order_time=day, quantity=4))
    put(spark, folder, created(2, 2, order_time=0, customer_id=None, quantity=None), created(2, 8, ts_ms=8, order_time=3 * day))
    assert figures() == {"1970-01-02": 2, "None": 1}
    put(spark, folder, created(3, 10, ts_ms=11, order_time=day), created(2, 2, order_time=0), deleted(4, 11, ts_ms=2))
    assert figures() == {"1970-01-02": 3}


def test_a_daily_batch_that_is_done_again_changes_nothing(spark, tmp_path, monkeypatch):
    let_workers_import(spark)
    folder, feed, daily = (str(tmp_path / n) for n in ("topic", "feed", "daily"))
    put(spark, folder, created(1, 1, order_time=0))
    put(spark, folder, created(1, 2, ts_ms=5, order_time=MICROS_PER_DAY), created(2, 3, order_time=0))
    feed_of(spark, folder, str(tmp_path / "c1"), feed)
    before = bag(daily_of(spark, feed, str(tmp_path / "c2"), daily, files=100))
    # as if the driver had died after the write and before the commit
    newest = max((tmp_path / "c2" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    for mark in (newest, newest.with_name(f".{newest.name}.crc")):
        mark.unlink(missing_ok=True)
    assert bag(daily_of(spark, feed, str(tmp_path / "c2"), daily, files=100)) == before
    plan = read_daily_sales(spark, daily)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "topic" not in plan and "feed" not in plan


def test_repeated_deliveries_are_dropped_before_the_sink(spark, tmp_path):
    folder, ckpt = str(tmp_path / "topic"), str(tmp_path / "ckpt")
    config = replace(CONFIG, repeats_within="1 hour")
    changelog = ChangeLog(spark, str(tmp_path / "log"), ORDERS, buckets=2)

    def deliver(*messages):
        put(spark, folder, *messages)
        source = read_topic_folder_stream(spark, folder, files_per_trigger=1)
        query = start_table(source, ORDERS, log_writer(changelog, 1), ckpt, config, available_now=True)
        query.awaitTermination()
        return [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]][-1]

    first = [created(1, 1, ts_ms=9), created(2, 2), created(2, 2), message("x", offset=3)]
    assert deliver(*first) == 3
    # the same again, a late older change, and a new one
    assert deliver(*first, created(1, 4, ts_ms=3), created(3, 5)) == 5
    assert sorted(r["offset"] for r in changelog.changes().collect()) == [1, 2, 4, 5]
    assert {r["id"]: r["_version"] for r in changelog.current().collect()} == {1: 9, 2: 1, 3: 1}


def test_state_of_repeats_does_not_grow(spark, tmp_path):
    folder = str(tmp_path / "topic")
    config = replace(CONFIG, repeats_within="0 seconds")
    changelog = ChangeLog(spark, str(tmp_path / "log"), ORDERS, buckets=2)
    for n in range(4):
        put(spark, folder, *(created(10 * n + i, 10 * n + i) for i in range(10)))
    source = read_topic_folder_stream(spark, folder, files_per_trigger=1)
    query = start_table(source, ORDERS, log_writer(changelog, 1), str(tmp_path / "ckpt"), config, available_now=True)
    query.awaitTermination()
    assert changelog.changes().count() == 40
    assert max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]) < 40


def test_hours_of_the_last_day_follow_the_stream(spark, tmp_path):
    let_workers_import(spark)
    folder, feed, minutes = (str(tmp_path / n) for n in ("topic", "feed", "minutes"))
    hour = MICROS_PER_DAY // 24
    clock = 10 * MICROS_PER_DAY + 5 * hour

    def figures(now):
        feed_of(spark, folder, str(tmp_path / "c1"), feed)
        stream = read_feed(spark, feed, ORDERS, files_per_trigger=100)
        query = start_hourly_orders(stream, minutes, str(tmp_path / "c2"), CONFIG, available_now=True)
        query.awaitTermination()
        rows = bag(read_hourly_orders(spark, minutes, F.lit(now)))
        live = current_rows(valid_changes(read_topic_folder(spark, folder), ORDERS))
        assert rows == bag(hourly_orders(live, F.lit(now)))
        return query

    put(spark, folder, created(1, 1, order_time=clock, quantity=3), created(2, 2, order_time=clock - 3 * hour, quantity=None),
        created(3, 3, order_time=clock - 40 * hour), created(4, 4, order_time=clock - MICROS_PER_DAY), created(5, 5, order_time=None))
    figures(clock)
    # a late order, one that moves into the day, one that goes, and one long before all of them
    put(spark, folder, created(6, 6, order_time=clock - 20 * hour), created(3, 7, ts_ms=2, order_time=clock - hour),
        deleted(1, 8, ts_ms=2), created(7, 9, order_time=0))
    figures(clock - hour)
    put(spark, folder, created(8, 10, order_time=clock + 9 * MICROS_PER_DAY))
    figures(clock + 9 * MICROS_PER_DAY)
    put(spark, folder, created(9, 11, order_time=clock + 9 * MICROS_PER_DAY - hour))
    query = figures(clock + 9 * MICROS_PER_DAY)
    # older minutes are evicted
    assert [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]][-1] <= 3


def test_progress_is_kept_as_a_table(spark, tmp_path):
    folder = str(tmp_path / "topic")
    changelog = ChangeLog(spark, str(tmp_path / "log"), ORDERS, buckets=2)
    put(spark, folder, created(1, 1), message("x", offset=2))
    put(spark, folder, created(2, 3), created(3, 4), message(None, offset=5))
    table = ProgressTable(spark, str(tmp_path / "progress"), every=1)
    spark.streams.addListener(table)
    try:
        query = run(spark, folder, log_writer(changelog, 1), str(tmp_path / "ckpt"))
        assert table.wait_for(query.runId)
    finally:
        spark.streams.removeListener(table)
    rows = read_progress(spark, table.path).filter("input_rows > 0").orderBy("batch_id").collect()
    assert sorted((r["rows"], r["rejected"]) for r in rows) == [(2, 1), (3, 1)]
    total = throughput(read_progress(spark, table.path)).first()
    assert (total["batches"], total["rows"], total["rejected"]) == (2, 5, 2) and total["rows_a_second"] > 0
