"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest
from compare import connect, mismatch

import __spark_entry__ as contract

KEYS = sorted(contract.core_queries())


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_its_sql():
    assert set(contract.oracles.all_sql()) == set(KEYS)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, con, small, key):
    found = mismatch(spark, con, small, contract.queries()[key], contract.oracle_sql()[key])
    assert found is None, found


def test_the_kept_orders_are_written_to_the_log_only(spark, small):
    changelog = contract._kept_orders(spark, small)
    beside = Path(changelog.root.removeprefix("file:")).parent
    assert [p.name for p in beside.iterdir()] == ["orders"]
    changes = contract.fixtures.changes(spark, small, "orders")
    assert changelog.changes().exceptAll(changes).isEmpty() and changes.exceptAll(changelog.changes()).isEmpty()
    assert changelog.batches() == {1: 2} and changelog.folded() == (1, {1: 1})
