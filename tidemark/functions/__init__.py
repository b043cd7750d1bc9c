"""Column expressions. All built-in Spark functions, no Python evaluation."""

from tidemark.functions.decimals import decode_decimal, encode_decimal
from tidemark.functions.text import (
    age_label,
    email_from_name,
    safe_cast,
    table_of_topic,
    topic_name,
    utf8_text,
)
from tidemark.functions.times import (
    as_of_micros,
    day_of,
    hour_of,
    micros_of,
    minutes_crossed,
    month_of,
    utc_timestamp,
)

__all__ = [
    "age_label",
    "as_of_micros",
    "day_of",
    "decode_decimal",
    "email_from_name",
    "encode_decimal",
    "hour_of",
    "micros_of",
    "minutes_crossed",
    "month_of",
    "safe_cast",
    "table_of_topic",
    "topic_name",
    "utc_timestamp",
    "utf8_text",
]
