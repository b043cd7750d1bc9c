"""Hand-written topic rows."""

from __future__ import annotations

import base64
import json
from datetime import datetime, timezone

from tidemark.schemas import TOPIC_ROW

_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)


def money(cents: int, width: int | None = None) -> str:
    """Wire form of a price; the shortest one unless a width in bytes is given."""
    size = width or max(1, (cents + (cents < 0)).bit_length() // 8 + 1)
    return base64.b64encode(cents.to_bytes(size, "big", signed=True)).decode()


def envelope(op, after=None, before=None, ts_ms=1, **extra) -> str:
    body = {"op": op, "after": after, "before": before, **extra}
    if ts_ms is not None:
        body["ts_ms"] = ts_ms
    return json.dumps(body)


def order(id, customer_id=1, product_id=1, quantity=1, order_time=0) -> dict:
    return {
        "id": id,
        "customer_id": customer_id,
        "product_id": product_id,
        "quantity": quantity,
        "order_time": order_time,
    }


def message(value, offset=0, key='{"id": 1}', topic="pg.public.orders", partition=0):
    """One row of ``TOPIC_ROW``."""
    raw_key = key.encode() if isinstance(key, str) else key
    raw_value = value.encode() if isinstance(value, str) else value
    as_bytes = [None if b is None else bytearray(b) for b in (raw_key, raw_value)]
    return (*as_bytes, topic, partition, offset, _AT, 0)


def topic(spark, *messages):
    return spark.createDataFrame(list(messages), TOPIC_ROW)


def flat(spark, spec, *rows):
    """Flat change rows from dicts; columns left out are NULL, place defaults to 0."""
    names = spec.flat_schema().fieldNames()
    defaults = {"_deleted": 0, "partition": 0, "offset": 0}
    values = [tuple({**defaults, **r}.get(n) for n in names) for r in rows]
    return spark.createDataFrame(values, spec.flat_schema())


def change(id, version, deleted=0, offset=0, **columns) -> dict:
    return {"id": id, "_version": version, "_deleted": deleted, "offset": offset, **columns}


def bag(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
