import base64
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import money

from tidemark.functions import (
    age_label,
    as_of_micros,
    day_of,
    decode_decimal,
    email_from_name,
    encode_decimal,
    hour_of,
    micros_of,
    minutes_crossed,
    month_of,
    safe_cast,
    table_of_topic,
    topic_name,
    utc_timestamp,
    utf8_text,
)

CENTS = [0, 1, -1, 127, 128, -128, -129, 70000, 120000, 9_999_999_999, -9_999_999_999]


def column(spark, values, ddl):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")


def evaluated(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize("width", [None, 8])
def test_prices_decode_exactly(spark, width):
    df = column(spark, [money(c, width) for c in CENTS], "string")
    want = [Decimal(c).scaleb(-2) for c in CENTS]
    assert evaluated(df, decode_decimal(F.col("v"), 10, 2)) == want


def test_wide_decimals_decode_exactly(spark):
    numbers = [0, -1, 2**63, -(2**63) - 1, 10**30 + 7, -(10**30) - 7, 10**37]
    df = column(spark, [money(n) for n in numbers], "string")
    want = [Decimal(f"{n}E-6") for n in numbers]
    assert evaluated(df, decode_decimal(F.col("v"), 38, 6)) == want


def test_what_is_no_price_is_null(spark):
    too_long = base64.b64encode(b"\x00" * 9 + b"\x01").decode()
    too_large = money(10**10)
    df = column(spark, ["!!!", "20.5", None, too_long, too_large], "string")
    assert evaluated(df, decode_decimal(F.col("v"), 10, 2)) == [None] * 5


def test_no_bytes_are_zero(spark):
    assert evaluated(column(spark, [""], "string"), decode_decimal(F.col("v"))) == [Decimal("0.00")]


def test_price_round_trip(spark):
    df = column(spark, [Decimal(c).scaleb(-2) for c in CENTS], "decimal(12,2)")
    coded = decode_decimal(encode_decimal(F.col("v")), 12, 2)
    assert evaluated(df, coded) == [Decimal(c).scaleb(-2) for c in CENTS]


def test_decimal_decoding_stays_in_the_jvm(spark):
    df = column(spark, [money(5)], "string").select(decode_decimal(F.col("v")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_utf8(spark):
    df = column(spark, [bytearray(b"ok"), bytearray(b"\xff\xfe"), None, bytearray("ü".encode())], "binary")
    assert evaluated(df, utf8_text(F.col("v"))) == ["ok", None, None, "ü"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    # The second one falls into the hour New York skips in spring.
    stamps = [datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 3, 10, 2, 30, 0, 5)]
    epoch = datetime(1970, 1, 1)
    micros = [(s - epoch).days * 86_400_000_000 + (s - epoch).seconds * 1_000_000 + s.microsecond for s in stamps]
    df = column(spark, micros, "bigint")
    v = F.col("v")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert evaluated(df, utc_timestamp(v)) == stamps
        assert evaluated(df, micros_of(utc_timestamp(v))) == micros
        assert evaluated(df, day_of(v)) == [date(1969, 12, 31), date(2024, 3, 10)]
        assert evaluated(df, month_of(v)) == [196912, 202403]
        assert evaluated(df, hour_of(v)) == [23, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_minutes_are_counted_by_crossing(spark):
    second = 1_000_000
    df = column(spark, [0], "int")
    pairs = [(59, 61, 1), (0, 59, 0), (61, 59, -1), (-1, 0, 1), (0, 3600, 60)]
    for start, end, want in pairs:
        got = evaluated(df, minutes_crossed(F.lit(start * second), F.lit(end * second)))
        assert got == [want]


def test_as_of_forms(spark):
    df = column(spark, [7], "bigint")
    aware = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
    assert evaluated(df, as_of_micros(aware)) == evaluated(df, as_of_micros(datetime(2024, 1, 1, 12)))
    assert evaluated(df, as_of_micros(F.col("v"))) == [7]
    now = evaluated(df, as_of_micros(None))[0]
    assert abs(now / 1e6 - datetime.now(timezone.utc).timestamp()) < 300


def test_age_labels(spark):
    df = column(spark, [0], "int")
    ages = {0: "0s ago", 59_999_999: "59s ago", 60_000_000: "1m ago", 3_599_999_999: "59m ago"}
    for age, want in ages.items():
        assert evaluated(df, age_label(F.lit(0), F.lit(age))) == [want]


def test_topic_names(spark):
    df = column(spark, ["pg.public.orders", "orders"], "string")
    assert evaluated(df, table_of_topic(F.col("v"))) == ["orders", "orders"]
    assert evaluated(df, topic_name(F.lit("pg"), F.lit("public"), F.lit("t")))[0] == "pg.public.t"


def test_safe_cast(spark):
    df = column(spark, ["5", " 6 ", "x", None], "string")
    assert evaluated(df, safe_cast(F.col("v"), "int", -1)) == [5, 6, -1, -1]
    assert evaluated(df, safe_cast(F.col("v"), "int")) == [5, 6, None, None]


def test_email(spark):
    df = column(spark, ["Ann Lee", "Bob"], "string")
    assert evaluated(df, email_from_name(F.col("v"))) == ["ann.lee@example.com", "bob@example.com"]
