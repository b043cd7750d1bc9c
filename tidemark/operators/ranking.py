"""Top-k, newest-k and repeatable samples. Each ends in a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top(df: DataFrame, measure: str, tie_break: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest measure; ties go to the lower key."""
    return df.orderBy(F.col(measure).desc(), F.col(tie_break).asc()).limit(n)


def random_rows(df: DataFrame, n: int, seed: int = 0, key: str = "id") -> DataFrame:
    """``n`` rows in an order set by a hash of key and seed, so a run can be repeated."""
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.orderBy(draw, F.col(key)).limit(n)
