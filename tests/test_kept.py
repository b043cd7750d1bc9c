from functools import partial

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import bag, change, envelope, flat, message, order, topic

import __spark_entry__ as entry
from tidemark.config import PipelineConfig
from tidemark.operators.changes import valid_changes
from tidemark.operators.deltas import table_delta
from tidemark.operators.drift import drift, new_rows
from tidemark.operators.state import current_rows
from tidemark.plans.sales import daily_sales
from tidemark.schemas import ORDERS
from tidemark.session import let_workers_import
from tidemark.sinks.changelog import ChangeLog
from tidemark.sources.kafka import read_topic_folder, read_topic_folder_stream
from tidemark.streaming import live
from tidemark.streaming.kept import KeptRows
from tidemark.streaming.metrics import read_daily_sales, start_daily_sales
from tidemark.streaming.retractions import net_rows, read_feed, start_feed

CONFIG = PipelineConfig()
COUNTS = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType())])


def summed(rows):
    return rows.groupBy("id").agg(F.sum("n").alias("n"))


def test_kept_rows_add_up_over_folds_and_replays(spark, tmp_path):
    kept, total = KeptRows(spark, str(tmp_path / "kept"), COUNTS, ["id"], summed, fold=2), {}
    for batch in range(7):
        rows = {i: batch * 10 + i for i in range(batch, batch + 3)}
        for attempt in range(2):  # each batch is done again
            put = kept.put(spark.createDataFrame([*rows.items(), *([(99, 1)] if attempt else [])], COUNTS), batch)
            assert dict(put.collect()) == rows | ({99: 1} if attempt else {})
            keys = spark.createDataFrame([(i,) for i in range(20)], "id long")
            assert dict(kept.before(keys, batch).filter("id < 99").collect()) == total
            assert dict(kept.before(keys.filter("id = 2"), batch).collect()) == {k: n for k, n in total.items() if k == 2}
        total = {i: total.get(i, 0) + rows.get(i, 0) for i in total | rows}
    assert sorted(f.name for f in (tmp_path / "kept").iterdir()) == ["fold=4", "fold=6"]


def put(spark, folder, *messages):
    topic(spark, *messages).coalesce(1).write.mode("append").parquet(folder)


def created(id, offset, ts_ms=1, **columns):
    return message(envelope("c", after=order(id, **columns), ts_ms=ts_ms), offset=offset)


def forget_commit(checkpoint):
    newest = max((checkpoint / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    for mark in (newest, newest.with_name(f".{newest.name}.crc")):
        mark.unlink(missing_ok=True)


def test_feed_and_daily_figures_call_no_python_for_a_key(spark, tmp_path):
    let_workers_import(spark)
    folder, feed, daily = (str(tmp_path / n) for n in ("topic", "feed", "daily"))
    put(spark, folder, *(created(i, i, order_time=0, customer_id=i % 3, quantity=i) for i in range(20)))
    put(spark, folder, *(created(i, 50 + i, ts_ms=2, order_time=0, customer_id=7) for i in range(0, 20, 3)))
    source = partial(read_topic_folder_stream, spark, folder, files_per_trigger=1)
    first = start_feed(source(), ORDERS, feed, str(tmp_path / "c1"), CONFIG, available_now=True)
    first.awaitTermination()
    second = start_daily_sales(read_feed(spark, feed, ORDERS), daily, str(tmp_path / "c2"), CONFIG, available_now=True)
    second.awaitTermination()
    # no state is asked for from Python, key by key
    assert [p["stateOperators"] for q in (first, second) for p in q.recentProgress if p["stateOperators"]] == []
    now = current_rows(valid_changes(read_topic_folder(spark, folder), ORDERS))
    assert bag(net_rows(spark.read.parquet(feed), ORDERS)) == bag(now.select("id", *ORDERS.columns))
    assert bag(read_daily_sales(spark, daily)) == bag(daily_sales(now))


def test_a_batch_of_the_feed_appears_once(spark, tmp_path):
    folder, feed = str(tmp_path / "topic"), str(tmp_path / "feed")
    put(spark, folder, created(1, 1, order_time=0), created(1, 2, ts_ms=3, order_time=5))
    for _ in range(2):
        start_feed(read_topic_folder_stream(spark, folder), ORDERS, feed, str(tmp_path / "c"), CONFIG, available_now=True).awaitTermination()
        files = set(spark.read.parquet(feed).inputFiles())
        assert [(r["id"], r["order_time"], r["_weight"]) for r in spark.read.parquet(feed).collect()] == [(1, 5, 1)]
        forget_commit(tmp_path / "c")
    assert set(spark.read.parquet(feed).inputFiles()) == files


def test_orders_of_a_parent_are_added_up_before_its_slot():
    columns = {"slot": [1, 1, 1, 2], "id": [5, 5, 6, 7], "refs": [1, 1, 1, 2], "items": [3, -1, 0, 4], "live": [0, 1, 0, 0]}
    types = pa.schema([("slot", pa.int32()), *((n, pa.int64()) for n in ("id", "refs", "items", "live"))])
    batch = pa.RecordBatch.from_pydict(columns, schema=types)
    rows = sorted(tuple(r.values()) for b in live._summed(iter([batch, batch])) for r in b.to_pylist())
    assert rows == [(1, 5, 4, 4, 2), (1, 6, 2, 0, 0), (2, 7, 4, 8, 0)]
    assert list(live._summed(iter([]))) == []


def test_orphans_are_summed_by_spark(spark, tmp_path):
    schema = "parent string, id long, refs long, items long, live long"
    folder, path = str(tmp_path / "rows"), str(tmp_path / "orphans")

    def step(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        query = live.start_orphans(spark.readStream.schema(schema).parquet(folder), path, str(tmp_path / "c"), CONFIG, available_now=True)
        query.awaitTermination()
        names = {s["operatorName"] for p in query.recentProgress for s in p["stateOperators"]}
        assert names == {"stateStoreSave"}
        return bag(live.read_orphans(spark, path))

    assert step(("customers", 1, 2, 0, 0), ("customers", 1, 1, 0, 0), ("customers", 2, 1, 0, 1)) == [("customers", 1, 3)]
    assert step(("customers", 1, 0, 0, 1), ("customers", 2, 0, 0, -1)) == [("customers", 2, 1)]


def scans(frame, what):
    return frame._jdf.queryExecution().executedPlan().toString().count(what)


def test_drift_goes_through_the_messages_once(spark, tmp_path):
    folder = str(tmp_path / "topic")
    put(spark, folder, *(created(i, i, order_time=0) for i in range(5)), message("not json", offset=9))
    # once for each message, and not again for the filter
    assert scans(new_rows(read_topic_folder(spark, folder)), "parseJson") == 1
    found = drift(read_topic_folder(spark, folder), ORDERS)
    assert scans(found, "topic") == 0 and found.count() == 0


def test_batches_of_a_staged_topic_do_not_grow_with_its_files(spark, tmp_path):
    folder = str(tmp_path / "many")
    spark.range(0, 70, 1, 7).write.parquet(folder)
    assert entry._third_of_files(spark, folder) == 3


def test_progress_takes_as_few_batches_with_many_files(spark, small, monkeypatch):
    took, topics = [], entry.fixtures.faulty_topic
    monkeypatch.setattr(entry.fixtures, "faulty_topic", lambda *a: topics(*a).repartition(12, "offset"))
    read = entry.read_topic_folder_stream

    def reading(spark, folder, files_per_trigger):
        took.append(files_per_trigger)
        return read(spark, folder, files_per_trigger=files_per_trigger)

    monkeypatch.setattr(entry, "read_topic_folder_stream", reading)
    rows = entry.stream_progress(spark, small)
    plain = {n: topics(spark, small, n).count() for n in ("customers", "products")}
    assert took == [4, 4] and {r["table_name"]: r["rows"] for r in rows.collect()} == plain


def test_first_fold_is_written_without_a_second_shuffle(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"), ORDERS, buckets=2)
    dealt = log.table.with_slot(log.table.dealt(log.changes()))
    assert dealt.rdd.getNumPartitions() % 2 == 0
    rows = flat(spark, ORDERS, *(change(i, 1, quantity=i) for i in range(40)))
    staged = str(tmp_path / "staged")
    slots = log._stage(rows, staged, None)
    assert slots == [0, 1] and sorted(f.name for f in (tmp_path / "staged").iterdir()) == ["rows"]
    files = [f for f in spark.read.parquet(f"{staged}/rows").inputFiles()]
    assert all("_slot=" in f for f in files)
    log.table.replace(log._staged_rows(staged), slots)
    assert bag(log.table.rows().select(*rows.columns)) == bag(rows)


def test_a_delta_joins_the_state_once(spark):
    before = flat(spark, ORDERS, *(change(i, 1, quantity=i) for i in range(6)))
    more = flat(spark, ORDERS, change(1, 2, quantity=9), change(2, 0, quantity=9), change(3, 5, deleted=1), change(8, 1, quantity=2))
    delta = table_delta(before, more)
    # one join that keeps the state's rows of changed keys and one that puts them beside the changes
    assert scans(delta, "LeftSemi") == 1 and scans(delta, "LeftOuter") == 1
    assert sorted((r["id"], r["quantity"], r["_weight"]) for r in delta.collect()) == [(1, 1, -1), (1, 9, 1), (3, 3, -1), (8, 2, 1)]
