"""The source database's constraints, as queries over a copy of its tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import TableSpec


def duplicates(rows: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` held by more than one row."""
    counted = rows.filter(F.col(column).isNotNull()).groupBy(column)
    return counted.agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def null_counts(tables: Mapping[str, tuple[DataFrame, TableSpec]]) -> DataFrame:
    """NULLs in every column that must not have any; one pass per table."""
    parts = []
    for name, (rows, spec) in tables.items():
        totals = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in spec.not_null))
        pairs = F.array(
            *(
                F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
                for c in spec.not_null
            )
        )
        parts.append(
            totals.select(F.inline(pairs)).select(
                F.lit(name).alias("table_name"), "column_name", "null_count"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def orphans(
    children: DataFrame, references: Mapping[str, tuple[str, DataFrame]]
) -> DataFrame:
    """Child rows whose parent is missing, one row per broken reference.

    ``references`` maps a parent table's name to the child's column and the
    parent rows. The children are gone through once, whatever the number of
    references: working out their state twice would cost more than carrying
    the row through one more join.
    """
    rows = children.select("id", *(column for column, _ in references.values()))
    missing = []
    for parent_name, (column, parents) in references.items():
        held = parents.select(F.col("id").alias(column)).distinct()
        rows = rows.join(held.withColumn(f"_{parent_name}", F.lit(True)), column, "left")
        broken = F.col(column).isNotNull() & F.col(f"_{parent_name}").isNull()
        finding = F.struct(
            F.lit(parent_name).alias("missing_parent"), F.col(column).alias("parent_id")
        )
        missing.append(F.when(broken, finding))
    return rows.select("id", F.inline(F.array_compact(F.array(*missing))))
