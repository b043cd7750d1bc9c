"""What a batch of changes does to a join, without joining everything again.

A table's delta is the rows it loses with weight -1 and those it gains with +1. For
the join of orders with their customers and products it follows by the product rule:
changed orders with the new parents, old orders with changed customers and new
products, old orders with old customers and changed products. Nothing is counted
twice, and each part starts from a delta.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import enrich_orders
from tidemark.operators.state import POSITION, latest_versions
from tidemark.streaming.retractions import WEIGHT


def table_delta(before: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Live rows that leave and enter a state (one row per key, deletes included) by a batch of changes."""
    newest = latest_versions(changes, key)
    names = newest.columns
    held = before.join(newest.select(key), key, "left_semi").select(F.col(key).alias("_held_key"), F.struct(*names).alias("_old"))
    offered = newest.select(F.col(key).alias("_key"), F.struct(*names).alias("_new"))
    place = lambda row: F.struct(*(F.col(row)[c] for c in POSITION))
    won = offered.join(held, F.col("_key") == F.col("_held_key"), "left").filter(
        F.col("_old").isNull() | (place("_old") <= place("_new"))
    )
    steps = F.array(*(F.struct(F.col(c).alias("row"), F.lit(w).alias(WEIGHT)) for c, w in (("_old", -1), ("_new", 1))))
    sent = won.select(F.inline(F.filter(steps, lambda step: step["row"]["_deleted"] == 0)))
    return sent.select("row.*", WEIGHT)


def enriched_delta(
    orders: tuple[DataFrame, DataFrame], customers: tuple[DataFrame, DataFrame], products: tuple[DataFrame, DataFrame]
) -> DataFrame:
    """``enrich_orders``' columns and the net weight of each row that leaves or enters.

    Each table is its live rows before the batch and its delta. The rows after the batch
    are the former with the latter, so they are not read anew.
    """

    def after(rows: DataFrame, delta: DataFrame) -> DataFrame:
        return rows.withColumn(WEIGHT, F.lit(1)).unionByName(delta)

    old = [rows.withColumn(WEIGHT, F.lit(1)) for rows, _ in (orders, customers, products)]
    delta = [changes for _, changes in (orders, customers, products)]
    new = [after(rows, changes) for rows, changes in (orders, customers, products)]
    parts = ((delta[0], new[1], new[2]), (old[0], delta[1], new[2]), (old[0], old[1], delta[2]))
    # the second part meets its delta, the customers, first
    joined = reduce(DataFrame.unionByName, (_weighted_join(*part, buyers_first=n == 1) for n, part in enumerate(parts)))
    names = [c for c in joined.columns if c != WEIGHT]
    return joined.groupBy(*names).agg(F.sum(WEIGHT).cast("int").alias(WEIGHT)).filter(F.col(WEIGHT) != 0)


def _weighted_join(orders: DataFrame, customers: DataFrame, products: DataFrame, buyers_first: bool) -> DataFrame:
    """The join, each row with the product of its parts' weights."""
    marked = (orders, "o"), (customers, "c"), (products, "p")
    of = {name: rows.withColumnRenamed(WEIGHT, f"_{name}") for rows, name in marked}
    joined = enrich_orders(of["o"], of["c"], of["p"], carry=("_o", "_c", "_p"), buyers_first=buyers_first)
    weight = (F.col("_o") * F.col("_c") * F.col("_p")).alias(WEIGHT)
    return joined.select(*(c for c in joined.columns if c not in ("_o", "_c", "_p")), weight)


def applied(rows: DataFrame, delta: DataFrame) -> DataFrame:
    """``rows`` with a delta's rows taken out and put in."""
    names = rows.columns
    both = rows.withColumn(WEIGHT, F.lit(1)).unionByName(delta)
    return both.groupBy(*names).agg(F.sum(WEIGHT).alias(WEIGHT)).filter(F.col(WEIGHT) > 0).select(*names)
