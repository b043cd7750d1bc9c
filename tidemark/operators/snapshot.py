"""A table's snapshot taken in chunks while its changes go on.

No lock and no single version of the table is needed: a chunk is a range of keys, read
at any moment between two positions of the log. What changed in between is known from
the log, so its keys are taken out of the chunk; what is left is as old as the lower
position and loses to every change after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import snapshot_changes
from tidemark.schemas import TableSpec


def settled_chunk(chunk: DataFrame, log: DataFrame, spec: TableSpec, low: int | Column, high: int | Column) -> DataFrame:
    """Snapshot changes of a chunk read after version ``low`` and before ``high`` of the log.

    ``chunk`` holds source rows, ``log`` flat changes that include all from ``low`` to
    ``high``. Keys changed in between come from the log alone.
    """
    version = F.col("_version")
    moved = log.filter((version > low) & (version <= high)).select(spec.key).distinct()
    return snapshot_changes(chunk.join(moved, spec.key, "left_anti"), spec, low)
