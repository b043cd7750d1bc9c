"""Text columns: byte decoding, topic names, labels."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf8_text(raw: Column) -> Column:
    """Bytes as text; NULL where they are not valid UTF-8."""
    return F.try_validate_utf8(raw.cast("string"))


def topic_name(database: Column, schema: Column, table: Column) -> Column:
    return F.concat_ws(".", database, schema, table)


def table_of_topic(topic: Column) -> Column:
    """Last dotted part of a topic name."""
    return F.substring_index(topic, ".", -1)


def safe_cast(value: Column, data_type: str, default: Any = None) -> Column:
    """Cast, or ``default`` where the value is NULL or does not convert."""
    return F.coalesce(value.try_cast(data_type), F.lit(default).cast(data_type))


def email_from_name(name: Column, separators: str = " ", domain: str = "example.com") -> Column:
    """Lower-case address from a name; every separator character becomes a dot."""
    dots = "." * len(separators)
    return F.concat(F.lower(F.translate(name, separators, dots)), F.lit(f"@{domain}"))


def age_label(then_micros: Column, now_micros: Column) -> Column:
    """``12s ago`` under a minute, ``3m ago`` from there on."""
    seconds = F.floor((now_micros - then_micros) / 1_000_000).cast("bigint")
    minutes = F.floor(seconds / 60).cast("bigint")
    return F.when(
        seconds < 60, F.concat(seconds.cast("string"), F.lit("s ago"))
    ).otherwise(F.concat(minutes.cast("string"), F.lit("m ago")))
