"""Source-table snapshots over JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import JdbcTarget


def partition_options(key: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options that split a JDBC scan into key ranges read in parallel."""
    if partitions < 1 or upper < lower:
        raise ValueError("need at least one partition and lower <= upper")
    return {
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_table(
    spark: SparkSession,
    source: JdbcTarget,
    table: str,
    key: str = "id",
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A table; in parallel key ranges if its key bounds are given."""
    reader = spark.read.format("jdbc").options(**source.options()).option("dbtable", table)
    if bounds is not None:
        reader = reader.options(**partition_options(key, *bounds, partitions))
    return reader.load()


def key_bounds(keys: DataFrame, parts: int, key: str = "id", accuracy: int = 100_000) -> list[int]:
    """Keys that cut a table into ``parts`` ranges of about equally many rows.

    Equal steps between the smallest and the largest key leave ranges empty and others
    full where keys lie close together; quantiles do not. They come from any copy of
    the keys, such as the kept state. Fewer bounds are returned if there are too few
    keys to cut.
    """
    if parts < 1:
        raise ValueError("need at least one range")
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = keys.agg(F.approx_percentile(key, shares, accuracy)).first()[0]
    return sorted(set(found or []))


def range_of(key: Column, bounds: Sequence[int]) -> Column:
    """Number of the range a key is in, from 0; a bound is the last key of its range."""
    number = F.lit(0)
    for bound in bounds:
        number = number + F.when(key > bound, 1).otherwise(0)
    return number


def range_predicates(bounds: Sequence[int], key: str = "id") -> list[str]:
    """SQL conditions of the ranges; every row meets one, rows without a key the first."""
    if not bounds:
        return ["1 = 1"]
    first, last = f"{key} <= {bounds[0]} OR {key} IS NULL", f"{key} > {bounds[-1]}"
    between = (f"{key} > {a} AND {key} <= {b}" for a, b in zip(bounds, bounds[1:]))
    return [first, *between, last]


def read_in_ranges(
    spark: SparkSession, source: JdbcTarget, table: str, bounds: Sequence[int], key: str = "id"
) -> DataFrame:
    """A table over JDBC, a task for each range that ``key_bounds`` found."""
    options = source.options()
    url = options.pop("url")
    return spark.read.jdbc(url, table, predicates=range_predicates(bounds, key), properties=options)


def snapshot_in_order(table: DataFrame, key: str = "id") -> DataFrame:
    """A whole table by ascending key, sorted in parallel ranges."""
    return table.orderBy(key)
