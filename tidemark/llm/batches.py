"""Texts as Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Bytes of text that one call of an operator's function gets, unless one text alone has more.
CHUNK_BYTES = 4 << 20
#: Bytes of an Arrow batch sent to a Python worker, unless one row alone has more.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Batches of texts stay small on both sides of the pipe, unless the session says how large.

    By default a batch takes 64 MB, which the JVM and the Python worker of every
    running task both hold.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes sum to the limit at most; a larger row stands alone."""
    first, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if total + size > limit and row > first:
            yield first, row
            first, total = row, 0
        total += size
    if len(sizes) > first:
        yield first, len(sizes)


def map_texts(
    docs: DataFrame,
    columns: list[str],
    text: str,
    added: list[tuple[str, DataType]],
    work: Callable[[list[str]], list[pa.Array]],
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``columns`` of each row and what ``work`` makes of the texts (null: empty).

    ``work`` gets a list of texts and returns one array for each added column.
    Only the named columns are read; others, whatever their names, are left out.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(*columns, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = StructType(
        [docs.schema[c] for c in columns] + [StructField(n, t) for n, t in added]
    )
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(batch.num_columns - 1)
            for a, b in slices(pc.binary_length(values).to_numpy(), chunk_bytes):
                kept = [batch.column(i).slice(a, b - a) for i in range(len(columns))]
                made = work(values.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([*kept, *made], names=names)
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema)


def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from all its values and the end of each row's part."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
