"""Change logs and topics derived from the star-schema test tables.

The constants below are shared with the SQL in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import email_from_name, encode_decimal, micros_of
from tidemark.schemas import CUSTOMERS, ORDERS, PRODUCTS, TOPIC_ROW, TableSpec

_HOUR_US = 3_600_000_000

# Ids derived from order keys outgrow 32 bits on large tables.
WIDE_ORDERS = ORDERS.with_long_ids()
WIDE_CUSTOMERS = CUSTOMERS.with_long_ids()
WIDE_PRODUCTS = PRODUCTS.with_long_ids()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _registered(key: str) -> Column:
    """1995-01-01 plus one hour per key, in epoch microseconds."""
    start = micros_of(F.expr("TIMESTAMP_NTZ '1995-01-01 00:00:00'"))
    return start + F.col(key) * _HOUR_US


def _all_order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order changes with the values deletes had, and their operation."""
    lines = table(spark, sf_dir, "lineitem")
    heads = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
    deleted = (F.col("l_partkey") % 7 == 0) | (F.col("o_custkey") % 11 == 0)
    op = (
        F.when(deleted, "d")
        .when(F.col("l_returnflag") == "R", "u")
        .when(F.col("l_returnflag") == "A", "c")
        .otherwise("r")
    )
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (micros_of(F.col("o_orderdate")) + (F.col("l_suppkey") % 24) * _HOUR_US).alias(
            "order_time"
        ),
        F.floor(micros_of(F.col("l_shipdate")) / 1000).cast("bigint").alias("_version"),
        op.alias("op"),
        F.lit(0).alias("partition"),
        (F.col("l_partkey") * 1000000000 + F.col("l_suppkey")).alias("offset"),
    )


def _all_customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = _registered("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        email_from_name(F.col("c_name"), "#").alias("email"),
        created.alias("created_at"),
        F.floor(created / 1000).cast("bigint").alias("_version"),
        F.when(F.col("c_custkey") % 13 == 0, "d").otherwise("c").alias("op"),
        F.lit(0).alias("partition"),
        F.col("c_custkey").alias("offset"),
    )


def _all_product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = _registered("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        created.alias("created_at"),
        F.floor(created / 1000).cast("bigint").alias("_version"),
        F.when(F.col("p_partkey") % 17 == 0, "d").otherwise("c").alias("op"),
        F.lit(0).alias("partition"),
        F.col("p_partkey").alias("offset"),
    )


_ROWS = {
    "orders": _all_order_rows,
    "customers": _all_customer_rows,
    "products": _all_product_rows,
}


def changes(spark: SparkSession, sf_dir: str, name: str, include_op: bool = False) -> DataFrame:
    """Flat change rows of a table, as its versioned table would hold them."""
    spec = {"orders": ORDERS, "customers": CUSTOMERS, "products": PRODUCTS}[name]
    rows = _ROWS[name](spark, sf_dir)
    gone = F.col("op") == "d"
    out = [
        F.col("id").cast("bigint"),
        *(F.when(~gone, F.col(c)).cast(spec.flat_type(c)).alias(c) for c in spec.columns),
        "_version",
        gone.cast("int").alias("_deleted"),
        "partition",
        "offset",
    ]
    if include_op:
        out.append("op")
    return rows.select(*out)


def _envelope_text(rows: DataFrame, spec: TableSpec) -> Column:
    """JSON of the change envelope; old rows travel in full."""
    fields = []
    for f in spec.record.fields:
        value = F.col(f.name)
        if f.name in spec.decimals:
            value = encode_decimal(value, spec.decimals[f.name][1])
        fields.append(value.cast(f.dataType).alias(f.name))
    row = F.struct(*fields)
    op = F.col("op")
    source = F.struct(
        F.col("_version").alias("ts_ms"),
        F.lit("public").alias("schema"),
        F.lit(spec.name).alias("table"),
    )
    return F.to_json(
        F.struct(
            F.when(op.isin("u", "d"), row).alias("before"),
            F.when(op != "d", row).alias("after"),
            source.alias("source"),
            op.alias("op"),
            F.col("_version").alias("ts_ms"),
        )
    )


def _as_topic(rows: DataFrame, spec: TableSpec, value: Column) -> DataFrame:
    stamped = rows.select(
        F.to_json(F.struct(F.col("id"))).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(spec.topic).alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.timestamp_millis("_version").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    return stamped.select(*TOPIC_ROW.fieldNames())


SPECS = {"orders": WIDE_ORDERS, "customers": WIDE_CUSTOMERS, "products": WIDE_PRODUCTS}


def _keyed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's changes as a topic deals them out: all of a key together."""
    return _ROWS[name](spark, sf_dir).repartition("id")


def topic(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's changes as topic rows."""
    spec = SPECS[name]
    rows = _keyed(spark, sf_dir, name)
    return _as_topic(rows, spec, _envelope_text(rows, spec))


def faulty_topic(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The topic with faults put in by offset, one kind per remainder of 19."""
    spec = SPECS[name]
    rows = _keyed(spark, sf_dir, name)
    text = _envelope_text(rows, spec)
    fault = F.col("offset") % 19
    value = (
        F.when(fault == 0, "not json")
        .when(fault == 1, F.lit(None).cast("string"))
        .when(fault == 2, F.regexp_replace(text, '"op":"[a-z]"', '"op":"t"'))
        .when(fault == 3, F.regexp_replace(text, r',"ts_ms":\d+\}$', "}"))
        .when(fault == 4, F.regexp_replace(text, r'"id":\d+', '"id":"none"'))
    )
    if spec.decimals:
        value = value.when(fault == 5, F.regexp_replace(text, '"price":"[^"]*"', '"price":"20.5"'))
    return _as_topic(rows, spec, value.otherwise(text))


#: Fields of which the drifted topics change the type.
RETYPED = {"orders": "quantity", "customers": "created_at", "products": "created_at"}


def drifted_topic(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The topic with departures from its schema put in by offset, one kind per remainder of 19."""
    spec = SPECS[name]
    rows = _keyed(spark, sf_dir, name)
    text, kind, field = _envelope_text(rows, spec), F.col("offset") % 19, RETYPED[name]
    value = (
        F.when(kind == 6, F.replace(text, F.lit('"after":{'), F.lit('"after":{"channel":"web",')))
        .when(kind == 7, F.regexp_replace(text, f'"{field}":(-?[0-9]+)', f'"{field}":"$1"'))
        .when(kind == 8, F.regexp_replace(text, f',"{field}":-?[0-9]+', ""))
        .when(kind == 9, "not json")
    )
    return _as_topic(rows, spec, value.otherwise(text))


def event_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as topic rows, one topic per event type.

    Keys are JSON; every tenth one starts with two bytes that are not UTF-8.
    """
    rows = table(spark, sf_dir, "events")
    key = F.to_json(F.struct(F.col("user_id").alias("id"))).cast("binary")
    broken = F.concat(F.unhex(F.lit("FFFE")), key)
    return rows.select(
        F.when(F.col("event_id") % 10 == 0, broken).otherwise(key).alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.concat(F.lit("app.public."), F.col("event_type")).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_micros(micros_of(F.col("ts"))).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def latest_micros(rows: DataFrame, column: str) -> Column:
    """The newest value of a column, as a clock for relative metrics."""
    return rows.agg(F.max(column)).scalar()


__all__ = [
    "SPECS",
    "changes",
    "event_topic",
    "faulty_topic",
    "latest_micros",
    "table",
    "topic",
]
