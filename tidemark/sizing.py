"""Size checks made before a plan relies on something being small."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def parse_bytes(text: str) -> int:
    """Spark's size notation (``10485760b``, ``10MB``, ``64k``) as bytes."""
    match = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", text.strip().lower())
    if not match:
        raise ValueError(f"not a size: {text!r}")
    return int(match.group(1)) * _UNITS[match.group(2)]


def broadcast_limit(spark: SparkSession) -> int:
    return parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a plan's output, from the file sizes of its inputs."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    return estimated_bytes(df) <= broadcast_limit(df.sparkSession)
