"""Decimals that travel as base64 of a signed big-endian unscaled integer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_TO_64 = 1 << 64


def _sign_extended(raw: Column, digits: int) -> Column:
    """Hex text of two's complement bytes, padded to ``digits`` with the sign."""
    text = F.hex(raw)
    fill = F.when(F.substring(text, 1, 1) >= "8", "F").otherwise("0")
    return F.when(F.length(text) <= digits, F.lpad(text, digits, fill))


def _unscaled_text(raw: Column, wide: bool) -> Column:
    """The integer as decimal text; NULL beyond 8 (narrow) or 16 (wide) bytes."""
    if not wide:
        return F.conv(_sign_extended(raw, 16), 16, -10)
    padded = _sign_extended(raw, 32)
    upper = F.conv(F.substring(padded, 1, 16), 16, -10).cast("decimal(20,0)")
    lower = F.conv(F.substring(padded, 17, 16), 16, 10).cast("decimal(20,0)")
    high = F.try_multiply(upper, F.lit(str(_TWO_TO_64)).cast("decimal(20,0)"))
    return F.try_add(high, lower).cast("string")


def decode_decimal(text: Column, precision: int = 10, scale: int = 2) -> Column:
    """Base64 text to decimal(precision, scale); NULL if it is none or too large."""
    raw = F.try_to_binary(text, F.lit("base64"))
    unscaled = _unscaled_text(raw, wide=precision > 18)
    return F.concat(unscaled, F.lit(f"E-{scale}")).try_cast(f"decimal({precision},{scale})")


def encode_decimal(value: Column, scale: int = 2) -> Column:
    """The 8-byte wire form of a decimal of at most 18 digits."""
    unscaled = (value * (10**scale)).cast("bigint")
    return F.base64(F.unhex(F.lpad(F.hex(unscaled), 16, "0")))
