import pytest
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import bag, change, flat

from tidemark.operators import state as state_ops
from tidemark.operators.changes import snapshot_changes
from tidemark.operators.state import (
    current_rows,
    expire_tombstones,
    latest_versions,
    live,
    merge_changes,
    overlay,
)
from tidemark.schemas import ORDERS

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def orders(spark, *rows):
    return flat(spark, ORDERS, *rows)


def ancestors(plan, line):
    """Lines of a printed plan above ``line`` in the tree, nearest first."""

    def depth(text):
        return max(text.find("+- "), text.find(":- "))

    at, found = depth(plan[line]), []
    for text in reversed(plan[:line]):
        if depth(text) < at:
            at = depth(text)
            found.append(text)
    return found


def test_newest_version_wins_in_any_order(spark):
    rows = orders(spark, change(1, 11, quantity=2), change(1, 10, quantity=1))
    assert latest_versions(rows).first()["quantity"] == 2


def test_equal_versions_are_decided_by_offset(spark):
    rows = orders(spark, change(1, 5, offset=2, quantity=2), change(1, 5, offset=1, quantity=1))
    assert latest_versions(rows).first()["quantity"] == 2


def test_a_deleted_key_is_not_shown_through_its_older_rows(spark):
    rows = orders(spark, change(1, 20, deleted=1), change(1, 15, quantity=1))
    assert current_rows(rows).count() == 0


def test_reinserted_key_is_live(spark):
    rows = orders(spark, change(1, 20, deleted=1), change(1, 30, quantity=1))
    assert current_rows(rows).count() == 1


def test_change_beats_snapshot_row_of_the_same_version(spark):
    table = spark.createDataFrame([(1, 2, 3, 4, 5)], "id int, customer_id int, product_id int, quantity int, order_time long")
    rows = snapshot_changes(table, ORDERS, 10).unionByName(orders(spark, change(1, 10, quantity=9)))
    assert latest_versions(rows).first()["quantity"] == 9


def test_versions_are_cut_before_the_shuffle(spark):
    rows = orders(spark, *(change(i % 3, i) for i in range(9)))
    plan = latest_versions(rows)._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_exchange


def test_live_filter_does_not_pass_the_reduction(spark):
    rows = orders(spark, change(1, 1), change(1, 2, deleted=1))
    plan = live(latest_versions(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("_deleted") < plan.index("Window")


histories = st.lists(
    st.tuples(st.integers(1, 5), st.integers(1, 6), st.integers(0, 1)), min_size=1, max_size=25
)


def _log(history):
    """Offsets make the order total, as they do in a topic."""
    return [change(i, v, d, offset=n, quantity=None if d else n) for n, (i, v, d) in enumerate(history)]


@SLOW
@given(histories, st.randoms())
def test_state_depends_on_neither_order_nor_repetition(spark, history, rng):
    log = _log(history)
    want = bag(latest_versions(orders(spark, *log)))
    shuffled = log + log
    rng.shuffle(shuffled)
    assert bag(latest_versions(orders(spark, *shuffled))) == want


@SLOW
@given(histories, st.integers(1, 4), st.booleans())
def test_folding_any_split_equals_reducing_the_whole(spark, history, parts, small):
    log = _log(history)
    pieces = [[] for _ in range(parts)]
    for row in log:
        pieces[random.Random(row["offset"]).randrange(parts)].append(row)
    whole = bag(latest_versions(orders(spark, *log)))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Both ways of merging: over the state by joins, and by one shuffle of both.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(2**62) if small else "-1")
    try:
        folded = orders(spark)
        for piece in pieces:
            folded = merge_changes(folded, orders(spark, *piece))
        assert bag(folded) == whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_overlay_does_not_shuffle_the_state(spark, tmp_path):
    held = orders(spark, *(change(i, 10, quantity=i) for i in range(50)))
    held.write.parquet(str(tmp_path / "state"))
    newer = orders(spark, change(3, 11, quantity=0), change(4, 9, quantity=0), change(99, 1))
    newer.write.parquet(str(tmp_path / "tail"))
    state = spark.read.parquet(str(tmp_path / "state"))
    tail = spark.read.parquet(str(tmp_path / "tail"))
    merged = merge_changes(state, tail)
    plan = merged._jdf.queryExecution().executedPlan().toString().splitlines()
    # the tail is shuffled for its newest rows; every other scan is of the state: once
    # in full width, once for keys and positions
    every = [n for n, line in enumerate(plan) if "Scan parquet" in line]
    scans = [n for n in every if "Window" not in "".join(ancestors(plan, n))]
    assert len(scans) == 2
    for scan in scans:
        parents = ancestors(plan, scan)
        assert "BroadcastHashJoin" in next(p for p in parents if "Join" in p or "Exchange" in p)
    got = {r["id"]: r["quantity"] for r in merged.collect()}
    assert len(got) == 51
    assert (got[3], got[4], got[99]) == (0, 4, None)
    assert bag(merged) == bag(latest_versions(state.unionByName(tail)))


@pytest.mark.parametrize("limit", ["-1", str(2**62)])
def test_shown_rows_do_not_depend_on_size(spark, limit):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        state = orders(spark, *(change(i, 1, quantity=i) for i in range(6)))
        tail = orders(spark, change(3, 2, quantity=9))
        merged = merge_changes(state, tail, shown=state.filter("id = 0"))
        assert sorted(r["id"] for r in merged.collect()) == [0, 3]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_tombstones_expire_by_version_only(spark):
    state = orders(spark, change(1, 5, deleted=1), change(2, 9, deleted=1), change(3, 5))
    assert sorted(r["id"] for r in expire_tombstones(state, 8).collect()) == [2, 3]


def test_overlay_prefers_the_offered_row_only_if_not_older(spark):
    state = orders(spark, change(1, 5, offset=7, quantity=1))
    same = orders(spark, change(1, 5, offset=7, quantity=1))
    older = orders(spark, change(1, 5, offset=6, quantity=2))
    assert overlay(state, same).count() == 1
    assert overlay(state, same, shown=state.filter("id = 0")).count() == 1
    assert overlay(state, older).first()["quantity"] == 1


def test_filter_on_key_reaches_the_scan(spark, tmp_path):
    orders(spark, *(change(i, 1) for i in range(5))).write.parquet(str(tmp_path / "log"))
    rows = current_rows(spark.read.parquet(str(tmp_path / "log"))).filter(F.col("id") == 3)
    assert "EqualTo(id,3)" in rows._jdf.queryExecution().executedPlan().toString()
