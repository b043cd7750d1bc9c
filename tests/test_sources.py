import random

import pytest
from pyspark.sql import functions as F
from rows import bag, change, envelope, flat, message, order, topic

from tidemark.operators.drift import drift, observed_schema
from tidemark.operators.snapshot import settled_chunk
from tidemark.operators.state import current_rows
from tidemark.schemas import ORDERS, PRODUCTS
from tidemark.sources.tables import key_bounds, range_of, range_predicates

# -- key ranges -----------------------------------------------------------


def test_ranges_hold_equally_many_rows_where_steps_do_not(spark):
    ids = list(range(9000)) + [10**6 + 900 * i for i in range(1000)]  # 90 % in 1 % of the range
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    bounds = key_bounds(rows, 20)
    sizes = [rows.filter(p).count() for p in range_predicates(bounds)]
    assert len(sizes) == 20 and sum(sizes) == 10_000 and max(sizes) <= 2 * 10_000 / 20
    counted = rows.groupBy(range_of(F.col("id"), bounds).alias("r")).count().orderBy("r").collect()
    assert [r["count"] for r in counted] == sizes
    step = max(ids) // 20
    assert sum(i < step for i in ids) > 8 * 10_000 / 20


@pytest.mark.parametrize("ids", [[], [None], [7], [7] * 30, [None, 1, 2]])
def test_ranges_of_few_keys(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    predicates = range_predicates(key_bounds(rows, 4))
    assert sum(rows.filter(p).count() for p in predicates) == len(ids)
    assert key_bounds(rows, 1) == [] and range_predicates([]) == ["1 = 1"]
    with pytest.raises(ValueError):
        key_bounds(rows, 0)


# -- snapshots in chunks --------------------------------------------------


def test_chunks_read_amid_changes_amount_to_the_state(spark):
    dice = random.Random(8)
    history = []
    for version in range(1, 400):
        key = dice.randrange(60)
        gone = dice.random() < 0.2
        columns = {} if gone else dict(customer_id=dice.randrange(9), product_id=1, quantity=version, order_time=0)
        history.append(change(key, version, deleted=int(gone), offset=version, **columns))
    log = flat(spark, ORDERS, *history)
    parts, started = [], 100
    for n in range(6):
        low = started + 40 * n
        high = low + dice.randrange(10, 40)
        read_at = dice.randrange(low, high + 1)  # changes fall before and after it
        source = current_rows(log.filter(F.col("_version") <= read_at)).filter(F.floor(F.col("id") / 10) == n)
        parts.append(settled_chunk(source, log, ORDERS, low, high))
    rows = log.filter(F.col("_version") > started)
    for part in parts:
        rows = rows.unionByName(part)
    columns = ["id", *ORDERS.columns]
    assert bag(current_rows(rows).select(columns)) == bag(current_rows(log).select(columns))


# -- schema drift ---------------------------------------------------------


def found(spark, spec, *messages):
    return {(r["field"], r["problem"], r["found_type"], r["rows"]) for r in drift(topic(spark, *messages), spec).collect()}


def test_departures_are_reported(spark):
    plain, wide = order(1), order(3_000_000_000)
    odd = {**order(1), "quantity": "7", "channel": None, "tags": ["a"]}
    less = {k: v for k, v in order(1).items() if k != "order_time"}
    got = found(
        spark, ORDERS, message(envelope("c", after=plain)), message(envelope("u", after=odd)), message(envelope("u", after=less)),
        message(envelope("c", after=wide)), message(envelope("d", before=odd)), message("not json"), message(None),
        message(envelope("c", after={**plain, "quantity": None})),
    )
    assert got == {
        ("channel", "unknown field", "VOID", 1),
        ("tags", "unknown field", "ARRAY<STRING>", 1),
        ("quantity", "changed type", "STRING", 1),
        ("order_time", "absent field", None, 1),
        ("id", "out of range", "BIGINT", 1),
    }
    assert found(spark, ORDERS.with_long_ids(), message(envelope("c", after=wide))) == set()


def test_a_topic_without_rows_has_no_departures(spark):
    assert found(spark, PRODUCTS) == found(spark, PRODUCTS, message(None), message(envelope("d", before={"id": 1}))) == set()
    assert {f for f, p, *_ in found(spark, PRODUCTS, message(envelope("c", after={})))} == {"id", "name", "price", "created_at"}


def test_the_schema_in_use(spark):
    rows = topic(spark, message(envelope("c", after={"id": 1, "x": 1.5})), message(envelope("c", after={"id": 2, "y": "a"})))
    assert observed_schema(rows).first()[0] == "OBJECT<id: BIGINT, x: DECIMAL(2,1), y: STRING>"
