"""Explicit schemas: topic rows, change envelopes, and one spec per table.

Nothing is inferred. What differs between tables is data in a ``TableSpec``;
the code that decodes and flattens them is the same.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Operation codes of the change envelope.
OP_CREATE, OP_UPDATE, OP_SNAPSHOT, OP_DELETE = "c", "u", "r", "d"
UPSERT_OPS = (OP_CREATE, OP_UPDATE, OP_SNAPSHOT)
KNOWN_OPS = (*UPSERT_OPS, OP_DELETE)

PROCESSING_VERSION = "1.0"  # fixed value

TOPIC_ROW = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """How one table's changes look on the wire and after flattening.

    ``record`` is the row as it travels, ``decimals`` the columns that travel as
    base64 unscaled integers with their (precision, scale), ``targets`` the
    columns whose flat type is wider than the wire type.
    """

    name: str
    topic: str
    record: T.StructType
    decimals: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    targets: Mapping[str, T.DataType] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    event_time: str | None = None
    key: str = "id"

    @property
    def columns(self) -> list[str]:
        """Business columns, the key excluded."""
        return [f.name for f in self.record.fields if f.name != self.key]

    @property
    def key_schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.key, self.record[self.key].dataType)])

    def envelope(self) -> T.StructType:
        """The whole change envelope."""
        source = T.StructType(
            [
                T.StructField("ts_ms", T.LongType()),
                T.StructField("schema", T.StringType()),
                T.StructField("table", T.StringType()),
            ]
        )
        return T.StructType(
            [
                T.StructField("before", self.record),
                T.StructField("after", self.record),
                T.StructField("source", source),
                T.StructField("op", T.StringType()),
                T.StructField("ts_ms", T.LongType()),
            ]
        )

    def narrow_envelope(self) -> T.StructType:
        """Only what flattening reads, so the parser builds nothing else."""
        return T.StructType(
            [
                T.StructField("before", self.key_schema),
                T.StructField("after", self.record),
                T.StructField("op", T.StringType()),
                T.StructField("ts_ms", T.LongType()),
            ]
        )

    def flat_type(self, column: str) -> T.DataType:
        if column in self.decimals:
            return T.DecimalType(*self.decimals[column])
        return self.targets.get(column, self.record[column].dataType)

    def flat_schema(self) -> T.StructType:
        """Schema of the flat change rows kept in the log and the state."""
        fields = [T.StructField(self.key, self.flat_type(self.key))]
        fields += [T.StructField(c, self.flat_type(c)) for c in self.columns]
        fields += [
            T.StructField("_version", T.LongType()),
            T.StructField("_deleted", T.IntegerType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
        ]
        return T.StructType(fields)

    def with_long_ids(self) -> TableSpec:
        """The same table fed from a source whose ids are 64-bit on the wire."""
        wide = [
            T.StructField(f.name, T.LongType())
            if f.name == self.key or f.name.endswith("_id")
            else f
            for f in self.record.fields
        ]
        return replace(self, record=T.StructType(wide))

    def on_topic(self, topic: str) -> TableSpec:
        return replace(self, topic=topic)


def _record(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


# Topic, table and column names and wire types are those of the sources.
CUSTOMERS = TableSpec(
    name="customers",
    topic="pg.public.customers",
    record=_record(
        id=T.IntegerType(), name=T.StringType(), email=T.StringType(), created_at=T.LongType()
    ),
    targets={"id": T.LongType()},
    not_null=("name", "email"),
)

PRODUCTS = TableSpec(
    name="products",
    topic="pg.public.products",
    record=_record(
        id=T.IntegerType(), name=T.StringType(), price=T.StringType(), created_at=T.LongType()
    ),
    decimals={"price": (10, 2)},
    targets={"id": T.LongType()},
    not_null=("name", "price"),
)

ORDERS = TableSpec(
    name="orders",
    topic="pg.public.orders",
    record=_record(
        id=T.IntegerType(),
        customer_id=T.IntegerType(),
        product_id=T.IntegerType(),
        quantity=T.IntegerType(),
        order_time=T.LongType(),
    ),
    targets={"id": T.LongType(), "customer_id": T.LongType(), "product_id": T.LongType()},
    not_null=("quantity",),
    event_time="order_time",
)

TABLES = {spec.name: spec for spec in (CUSTOMERS, PRODUCTS, ORDERS)}
