from datetime import datetime, timedelta, timezone

from rows import envelope, message, order

from tidemark.operators import events
from tidemark.schemas import TOPIC_ROW

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def rows(spark, *specs):
    """(topic, offset, seconds after start, op) to topic rows."""
    out = []
    for name, offset, seconds, op in specs:
        row = list(message(envelope(op, after=order(1)), offset=offset, topic=name))
        row[5] = START + timedelta(seconds=seconds)
        out.append(tuple(row))
    return spark.createDataFrame(out, TOPIC_ROW)


SPECS = [
    ("pg.public.orders", 1, 0, "c"),
    ("pg.public.orders", 2, 400, "u"),
    ("pg.public.customers", 1, 350, "c"),
    ("pg.public.products", 1, 399, "c"),
]


def test_preview_is_newest_first_and_aged(spark):
    got = events.preview(rows(spark, *SPECS), limit=2, as_of=START + timedelta(seconds=460)).collect()
    assert [(r["topic"], r["offset"], r["age"]) for r in got] == [
        ("pg.public.orders", 2, "1m ago"),
        ("pg.public.products", 1, "1m ago"),
    ]
    assert got[0]["timestamp"] == datetime(2024, 1, 1, 0, 6, 40)
    assert got[0]["key"] == '{"id": 1}'


def test_preview_of_the_last_minutes_and_of_topics(spark):
    clock = START + timedelta(seconds=410)
    assert events.preview(rows(spark, *SPECS), as_of=clock, minutes=5).count() == 3
    only = events.preview(rows(spark, *SPECS), as_of=clock, topics=["pg.public.customers"])
    assert [r["age"] for r in only.collect()] == ["1m ago"]


def test_the_last_messages_of_each_partition(spark):
    busy = [("pg.public.orders", n, n, "c") for n in range(20)]
    got = events.newest_per_partition(rows(spark, *busy, *SPECS[2:]), 3).collect()
    assert sorted((r["topic"], r["offset"]) for r in got) == [
        ("pg.public.customers", 1),
        *(("pg.public.orders", n) for n in (17, 18, 19)),
        ("pg.public.products", 1),
    ]
    assert events.newest_per_partition(rows(spark)).count() == 0


def test_summary_and_counts(spark):
    df = rows(spark, *SPECS)
    got = events.summary(df).first()
    assert (got["total_messages"], got["active_topics"]) == (4, 3)
    assert got["latest_message"] == datetime(2024, 1, 1, 0, 6, 40)
    assert {r["table_name"]: r["events"] for r in events.counts_by_table(df).collect()} == {
        "orders": 2,
        "customers": 1,
        "products": 1,
    }
    assert events.of_operation(df, "u").count() == 1
    assert events.of_topics(df, ["pg.public.orders"]).count() == 2
    by_op = {(r["topic"], r["op"]): r["events"] for r in events.counts_by_op(df).collect()}
    assert by_op[("pg.public.orders", "u")] == 1


def test_topics_are_put_together(spark):
    a, b = rows(spark, SPECS[0]), rows(spark, SPECS[2])
    assert events.all_topics(a, b).count() == 2
