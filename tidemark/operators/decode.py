"""Topic rows to typed change envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import utf8_text
from tidemark.schemas import TableSpec


def read_text(rows: DataFrame) -> DataFrame:
    """Add ``key_str`` and ``value_str``.

    A key that is not UTF-8 becomes NULL; a value keeps replacement characters.
    """
    return rows.withColumns(
        {"key_str": utf8_text(F.col("key")), "value_str": F.col("value").cast("string")}
    )


def parse_envelope(
    rows: DataFrame, spec: TableSpec, keep_text: bool = False, narrow: bool = False
) -> DataFrame:
    """Add ``key_json`` and ``value_json``; drop the raw columns.

    ``narrow`` parses just the fields flattening needs, ``keep_text`` leaves the
    two text columns in place for the quarantine.
    """
    schema = spec.narrow_envelope() if narrow else spec.envelope()
    parsed = rows.withColumns(
        {
            "key_json": F.from_json("key_str", spec.key_schema),
            "value_json": F.from_json("value_str", schema),
        }
    ).drop("key", "value")
    return parsed if keep_text else parsed.drop("key_str", "value_str")


def decode(rows: DataFrame, spec: TableSpec, narrow: bool = False) -> DataFrame:
    """Topic rows to parsed envelopes, texts dropped."""
    return parse_envelope(read_text(rows), spec, narrow=narrow)
