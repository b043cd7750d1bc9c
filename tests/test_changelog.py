import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from rows import bag, change, envelope, flat, message, order, topic

from tidemark.functions.times import MICROS_PER_DAY
from tidemark.operators.changes import triage
from tidemark.operators.state import latest_versions
from tidemark.schemas import CUSTOMERS, ORDERS
from tidemark.sinks.changelog import SENT_KEYS, ChangeLog
from tidemark.sinks.rollup import read_rollup, rebuild_rollup, roll_yesterday


def batch(spark, *changes):
    rows = flat(spark, ORDERS, *changes)
    return rows.withColumns({c: F.lit(None).cast("string") for c in ("reason", "key_text", "value_text")})


@pytest.fixture
def changelog(spark, tmp_path):
    return ChangeLog(spark, str(tmp_path / "orders"), ORDERS, buckets=4)


def test_a_new_log_is_empty(changelog):
    assert changelog.changes().count() == 0
    assert changelog.state().count() == 0
    assert changelog.current().count() == 0
    assert changelog.compacted().count() == 0
    assert changelog.batches() == {}


def test_replaying_a_batch_replaces_it(spark, changelog):
    changelog.write_batch(batch(spark, change(1, 1), change(2, 1)), 0)
    changelog.write_batch(batch(spark, change(3, 1)), 1)
    changelog.write_batch(batch(spark, change(1, 1), change(2, 1)), 0)
    assert changelog.changes().count() == 3
    changelog.write_batch(batch(spark), 0)
    assert [r["id"] for r in changelog.changes().collect()] == [3]


def test_checkpoint_versions_keep_their_batches_apart(spark, changelog):
    changelog.write_batch(batch(spark, change(1, 1, quantity=1)), 0, ckpt=1)
    changelog.write_batch(batch(spark, change(1, 1, quantity=1), change(2, 1)), 0, ckpt=2)
    assert changelog.changes().count() == 3
    assert changelog.state().count() == 2
    assert changelog.batches() == {1: 0, 2: 0}


def test_quarantine_lies_beside_the_valid_rows(spark, changelog):
    rows = topic(
        spark,
        message(envelope("c", after=order(1)), offset=1),
        message("not json", offset=2),
        message(None, offset=3),
    )
    changelog.write_batch(triage(rows, ORDERS), 0)
    assert [r["offset"] for r in changelog.changes().collect()] == [1]
    kept = changelog.quarantine().collect()
    assert [(r["offset"], r["reason"], r["value_text"]) for r in kept] == [(2, "unparseable", "not json")]


HISTORY = [
    [change(1, 10, quantity=1, order_time=0), change(2, 10, quantity=2, order_time=MICROS_PER_DAY)],
    [change(1, 20, deleted=1), change(3, 20, quantity=3, order_time=40 * MICROS_PER_DAY)],
    [change(1, 15, quantity=9, order_time=0), change(2, 30, quantity=4, order_time=0)],
]


def test_compacted_state_and_tail_equal_the_whole_log(spark, changelog):
    for n, rows in enumerate(HISTORY):
        changelog.write_batch(batch(spark, *rows), n)
    whole = bag(latest_versions(changelog.changes()))
    assert bag(changelog.state()) == whole
    assert changelog.compact(through={1: 1}) == 1
    assert changelog.folded() == (1, {1: 1})
    # The late older change of a deleted order does not bring it back.
    assert bag(changelog.state()) == whole
    assert changelog.compact(through={1: 2}) == 2
    assert bag(changelog.state()) == whole
    assert sorted(r["id"] for r in changelog.current().collect()) == [2, 3]


def test_default_compaction_leaves_the_newest_batch_out(spark, changelog):
    for n, rows in enumerate(HISTORY):
        changelog.write_batch(batch(spark, *rows), n)
    changelog.compact()
    assert changelog.folded() == (1, {1: 1})


def test_state_as_of_an_earlier_batch(spark, changelog):
    for n, rows in enumerate(HISTORY):
        changelog.write_batch(batch(spark, *rows), n)
    earlier = changelog.state(through={1: 0})
    assert sorted((r["id"], r["_version"]) for r in earlier.collect()) == [(1, 10), (2, 10)]


def test_recent_rows_are_pruned_by_time(spark, changelog):
    for n, rows in enumerate(HISTORY):
        changelog.write_batch(batch(spark, *rows), n)
    changelog.compact(through={1: 2})
    recent = changelog.compacted(since=datetime(1970, 2, 1))
    assert [r["id"] for r in recent.collect()] == [3]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_time" in plan[plan.index("PushedFilters") :]


def files_by_slot(changelog):
    found = {}
    for file in changelog.table.rows().inputFiles():
        found.setdefault(file.split("_slot=")[1].split("/")[0], set()).add(file)
    return found


def test_a_fold_rewrites_the_buckets_it_changes(spark, changelog):
    changelog.write_batch(batch(spark, *(change(i, 1, quantity=i) for i in range(100))), 0)
    changelog.compact(through={1: 0})
    before = files_by_slot(changelog)
    assert sorted(before) == ["0", "1", "2", "3"]
    # a change of one key, and one that is older than what is there
    changelog.write_batch(batch(spark, change(7, 5, quantity=0), change(8, 0, quantity=0)), 1)
    whole = bag(changelog.state())
    changelog.compact(through={1: 1})
    after = files_by_slot(changelog)
    own = changelog.table.rows().filter("id = 7").first()["_slot"]
    assert [s for s in before if before[s] != after[s]] == [str(own)]
    assert bag(changelog.state()) == whole == bag(latest_versions(changelog.changes()))
    assert changelog.table.rows().filter("_slot != pmod(hash(id), 4)").count() == 0


def test_changes_that_lose_rewrite_nothing(spark, changelog):
    changelog.write_batch(batch(spark, change(1, 9), change(2, 9)), 0)
    changelog.compact(through={1: 0})
    before = files_by_slot(changelog)
    changelog.write_batch(batch(spark, change(1, 3)), 1)
    assert changelog.compact(through={1: 1}) == 2
    assert files_by_slot(changelog) == before and changelog.folded() == (2, {1: 1})


def test_the_state_is_joined_without_a_shuffle(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "orders"), ORDERS, buckets=8)
    log.write_batch(batch(spark, *(change(i, 1) for i in range(200))), 0)
    log.compact(through={1: 0})
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        kept = log.compacted()
        joined = kept.join(kept.select("id", F.col("quantity").alias("q")), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_folded_batches_can_go_and_quarantine_stays(spark, changelog):
    for n, rows in enumerate(HISTORY):
        changelog.write_batch(batch(spark, *rows), n)
    rejected = topic(spark, message("not json", offset=2))
    changelog.write_batch(triage(rejected, ORDERS).unionByName(batch(spark, change(4, 1))), 3)
    whole = bag(changelog.state())
    assert changelog.drop_folded() == 0
    changelog.compact(through={1: 1})
    assert changelog.drop_folded() == 2
    assert bag(changelog.state()) == whole
    changelog.compact(through={1: 3})
    assert changelog.drop_folded() == 2
    assert bag(changelog.state()) == whole
    assert changelog.batches() == {} and changelog.quarantine().count() == 1


@pytest.mark.parametrize("dies_in", ["table", "mark"])
def test_a_fold_that_died_is_finished_by_the_next(spark, changelog, monkeypatch, dies_in):
    for n, rows in enumerate(HISTORY):
        changelog.write_batch(batch(spark, *rows), n)
    whole = bag(changelog.state())
    changelog.compact(through={1: 0})
    real_replace, real_mark = changelog.table.replace, changelog._mark

    def dies(*args, **options):
        if dies_in == "table":
            real_replace(*args, **options)
            raise RuntimeError("lost")
        if options.get("done"):
            raise RuntimeError("lost")
        real_mark(*args, **options)

    monkeypatch.setattr(*((changelog.table, "replace") if dies_in == "table" else (changelog, "_mark")), dies)
    with pytest.raises(RuntimeError, match="lost"):
        changelog.compact(through={1: 1})
    monkeypatch.undo()
    assert changelog.folded() == (1, {1: 0}) and bag(changelog.state()) == whole
    again = ChangeLog(spark, changelog.root, ORDERS, buckets=4)  # as after a restart
    assert again.compact(through={1: 2}) == 3
    assert again.folded() == (3, {1: 2}) and bag(again.state()) == whole


def test_a_first_fold_is_written_once(spark, changelog, monkeypatch):
    for n, rows in enumerate(HISTORY):
        changelog.write_batch(batch(spark, *rows), n)
    whole = bag(changelog.state())

    def staged(*args):
        raise AssertionError("the rows were staged")

    monkeypatch.setattr(changelog, "_stage", staged)
    assert changelog.compact(through={1: 1}) == 1
    assert changelog.folded() == (1, {1: 1}) and bag(changelog.state()) == whole
    assert changelog.table.rows().filter("_slot != pmod(hash(id), 4)").count() == 0


def test_a_first_fold_that_died_leaves_nothing_behind(spark, changelog, monkeypatch):
    changelog.write_batch(batch(spark, change(1, 10, deleted=1), change(2, 2000)), 0)

    def dies(*args, **options):
        raise RuntimeError("lost")

    monkeypatch.setattr(changelog, "_mark", dies)
    with pytest.raises(RuntimeError, match="lost"):
        changelog.compact(through={1: 0})
    monkeypatch.undo()
    assert changelog.folded() == (0, {}) and changelog.table.rows().count() == 2
    assert sorted(r["id"] for r in changelog.state().collect()) == [1, 2]
    again = ChangeLog(spark, changelog.root, ORDERS, buckets=4)  # as after a restart
    assert again.compact(through={1: 0}, expire_before=1000) == 1
    assert [r["id"] for r in again.table.rows().collect()] == [2]
    assert again.folded() == (1, {1: 0}) and [r["id"] for r in again.state().collect()] == [2]


def test_a_state_bucket_that_loses_its_last_row_is_emptied(spark, changelog):
    changelog.write_batch(batch(spark, change(1, 10, deleted=1), change(2, 2000)), 0)
    changelog.compact(through={1: 0})
    changelog.write_batch(batch(spark), 1)
    changelog.compact(through={1: 1}, expire_before=1000)
    assert [r["id"] for r in changelog.table.rows().collect()] == [2]


def test_another_session_reads_the_folded_state(spark, changelog):
    for n, rows in enumerate(HISTORY):
        changelog.write_batch(batch(spark, *rows), n)
    changelog.compact(through={1: 1})
    spark.sql(f"DROP TABLE {changelog.table.name}")  # forgets the name, not the files
    other = ChangeLog(spark.newSession(), changelog.root, ORDERS, buckets=4)
    assert bag(other.state()) == bag(latest_versions(other.changes()))
    assert other.compacted().count() > 0


def test_tables_without_event_time_compact_too(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "customers"), CUSTOMERS, buckets=2)
    rows = flat(spark, CUSTOMERS, change(1, 1, name="A"), change(1, 2, name="B"))
    log.write_batch(rows.withColumns({c: F.lit(None).cast("string") for c in ("reason", "key_text", "value_text")}), 0)
    log.compact(through={1: 0})
    assert [r["name"] for r in log.current().collect()] == ["B"]


def _orders(spark, *rows):
    return flat(spark, ORDERS, *(change(i, 1, customer_id=c, product_id=1, quantity=q, order_time=t) for i, c, q, t in rows))


def test_rolling_a_day_twice_counts_it_once(spark, tmp_path):
    path = str(tmp_path / "rollup")
    orders = _orders(spark, (1, 1, 2, 5), (2, 1, 4, 6), (3, 2, 9, MICROS_PER_DAY))
    for _ in range(2):
        roll_yesterday(orders, path, datetime(1970, 1, 2, 12))
    row = read_rollup(spark, path).first().asDict()
    assert row == {
        "date": date(1970, 1, 1),
        "total_orders": 2,
        "total_customers": 1,
        "total_items_sold": 6,
        "unique_products_sold": 1,
        "avg_items_per_order": 3.0,
    }
    assert read_rollup(spark, path).count() == 1


def test_a_day_that_lost_its_orders_disappears(spark, tmp_path):
    path = str(tmp_path / "rollup")
    roll_yesterday(_orders(spark, (1, 1, 2, 5)), path, datetime(1970, 1, 2))
    roll_yesterday(_orders(spark), path, datetime(1970, 1, 2))
    assert read_rollup(spark, path).count() == 0


def test_rebuilding_and_rolling_agree(spark, tmp_path):
    orders = _orders(spark, (1, 1, 2, 5), (2, 1, 4, MICROS_PER_DAY))
    rebuild_rollup(orders, str(tmp_path / "a"))
    for day in (2, 3):
        roll_yesterday(orders, str(tmp_path / "b"), datetime(1970, 1, day))
    assert bag(read_rollup(spark, str(tmp_path / "a"))) == bag(read_rollup(spark, str(tmp_path / "b")))


def test_a_batch_is_read_from_its_own_folder(spark, changelog):
    changelog.write_batch(batch(spark, change(1, 1)), 0)
    changelog.write_batch(batch(spark, change(2, 1)), 1)
    found = changelog.batch(1)
    assert [r["id"] for r in found.collect()] == [2]
    assert all("batch_id=1/" in f for f in found.inputFiles())


def test_the_tail_is_read_from_its_own_folders(spark, changelog):
    for n, rows in enumerate(HISTORY):
        changelog.write_batch(batch(spark, *rows), n)
    tail = changelog.changes(after={1: 1})
    assert sorted(r["id"] for r in tail.collect()) == [1, 2]
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert changelog.changes(after={1: 2}).count() == 0
    assert changelog.changes(through={2: 5}).count() == 0
    assert changelog.changes(through={2: 5}, others=True).count() == changelog.changes().count()


def test_empty_batches_hold_nothing(spark, changelog):
    changelog.write_batch(batch(spark, change(1, 1)), 0)
    changelog.write_batch(batch(spark), 1)
    assert changelog.batches() == {1: 0}
    assert changelog.batch(1).count() == 0
    assert [r["id"] for r in changelog.current().collect()] == [1]


DAY = MICROS_PER_DAY
BEFORE = [
    change(1, 10, order_time=0),  # moved to a recent day by the tail
    change(2, 10, order_time=50 * DAY),  # moved to an old day by the tail
    change(3, 30, order_time=0),  # newer than what the tail says of it
    change(4, 10, order_time=51 * DAY),  # untouched
    change(5, 10, order_time=52 * DAY),  # deleted by the tail
    change(6, 10, order_time=1 * DAY),  # untouched and old
    change(7, 10, order_time=None),  # without a time
    change(8, 30, deleted=1),  # a tombstone newer than what the tail says
]
AFTER = [
    change(1, 20, order_time=53 * DAY),
    change(2, 20, order_time=2 * DAY),
    change(3, 20, order_time=54 * DAY),
    change(5, 20, deleted=1),
    change(8, 20, order_time=55 * DAY),
    change(9, 20, order_time=56 * DAY),
    change(10, 20, order_time=3 * DAY),
]


@pytest.mark.parametrize("compacted", [False, True])
def test_recent_rows_equal_a_filter_on_all_live_rows(spark, changelog, compacted):
    changelog.write_batch(batch(spark, *BEFORE), 0)
    changelog.write_batch(batch(spark, *AFTER), 1)
    if compacted:
        changelog.compact(through={1: 0})
    recent = changelog.recent(datetime(1970, 2, 15))
    assert sorted(r["id"] for r in recent.collect()) == [1, 4, 9]
    assert bag(recent) == bag(changelog.current().filter(F.col("order_time") >= 45 * DAY))


def test_recent_rows_read_other_rows_for_positions_only(spark, changelog):
    changelog.write_batch(batch(spark, *BEFORE), 0)
    changelog.write_batch(batch(spark, *AFTER), 1)
    changelog.compact(through={1: 0})
    recent = changelog.recent(datetime(1970, 2, 15))
    text = recent._jdf.queryExecution().executedPlan().toString()
    kept = [line for line in text.splitlines() if "FileScan parquet" in line and "_slot#" in line]
    pruned = [line for line in kept if "GreaterThanOrEqual(order_time" in line]
    assert len(pruned) == 1 and len(kept) > 1
    assert all("quantity" not in line for line in kept if line not in pruned)


@pytest.mark.parametrize("compacted", [False, True])
def test_only_rows_of_wanted_keys_are_shuffled_for_recent_ones(spark, changelog, compacted):
    changelog.write_batch(batch(spark, *BEFORE), 0)
    changelog.write_batch(batch(spark, *AFTER), 1)
    if compacted:
        changelog.compact(through={1: 0})
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = changelog.recent(datetime(1970, 2, 15))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # the tail once, or over a folded state three times beside the state's positions
    assert plan.count("LeftSemi, BuildRight") == (4 if compacted else 1)


def odd_history():
    """Changes of few keys at random, some without key, version or time; none twice at one place."""
    draw = random.Random(5)
    return [
        [
            change(
                draw.choice([*range(40), None]),
                draw.choice([*range(9), None]),
                deleted=int(draw.random() < 0.2),
                offset=100 * n + i,
                quantity=i,
                order_time=draw.choice([*range(0, 60 * DAY, DAY // 2), None]),
            )
            for i in range(60)
        ]
        for n in range(3)
    ]


@pytest.mark.parametrize("sent", [0, SENT_KEYS])
@pytest.mark.parametrize("folded", [None, 1])
def test_recent_and_newest_rows_of_an_odd_history(spark, changelog, monkeypatch, folded, sent):
    monkeypatch.setattr("tidemark.sinks.changelog.SENT_KEYS", sent)
    for n, rows in enumerate(odd_history()):
        changelog.write_batch(batch(spark, *rows), n)
    if folded is not None:
        changelog.compact(through={1: folded})
    for since in (0, 58 * DAY):
        whole = changelog.current().filter(F.col("order_time") >= since)
        assert bag(changelog.recent(F.lit(since))) == bag(whole)
    assert changelog.newest() == changelog.current().agg(F.max("order_time")).first()[0]


def test_the_newest_time_is_that_of_a_live_row(spark, changelog):
    assert changelog.newest() is None
    changelog.write_batch(batch(spark, change(1, 10, order_time=90 * DAY), change(2, 10, order_time=3 * DAY)), 0)
    assert changelog.newest() == 90 * DAY
    changelog.compact(through={1: 0})
    changelog.write_batch(batch(spark, change(1, 20, order_time=5 * DAY), change(3, 20, order_time=None)), 1)
    assert changelog.newest() == 5 * DAY
    changelog.write_batch(batch(spark, change(1, 30, deleted=1)), 2)
    assert changelog.newest() == 3 * DAY


def test_maintenance_folds_drops_and_expires(spark, changelog):
    for n in range(6):
        changelog.write_batch(batch(spark, change(n, 10 + n), change(100, 10 + n, deleted=1)), n)
        before = bag(changelog.current())
        changelog.maintain(n, 1, every=2, drop_folded=True)
        assert bag(changelog.current()) == before
    assert changelog.folded() == (3, {1: 4})
    assert changelog._batches() == [(1, 5)]
    assert changelog.state().filter("id = 100").count() == 1
    for n in (6, 7):
        changelog.write_batch(batch(spark), n)
    changelog.maintain(7, 1, every=2, drop_folded=True, keep_ms=1000)
    assert changelog.state().filter("id = 100").count() == 0
    assert changelog.current().count() == 6
