"""Rows by key that a streaming query keeps from batch to batch, as files beside its checkpoint.

Layout below the folder::

    fold=<n>/batch=-1/    what the batches before n amount to
    fold=<n>/batch=<m>/   rows of the batch m, at most one a key

Every few batches those before are folded into one folder, so what a batch reads is
bounded by the rows that are kept. It is joined with them by Spark: few keys are
broadcast and the kept rows streamed past them, many are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.session import delete_folder

#: So many batches are folded at a time.
FOLD = 20
#: The order of the batches, as ``merge`` sees it.
BATCH = "batch"


class KeptRows:
    """``merge`` makes at most one row a key of kept rows; keys hold no NULL."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: Sequence[str],
        merge: Callable[[DataFrame], DataFrame],
        fold: int = FOLD,
    ):
        self._spark, self.path, self._schema = spark, path, schema
        self._key, self._merge, self._fold = list(key), merge, fold

    def put(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Write a batch's rows in place of what an earlier attempt left, and return them as written."""
        start = self._start(batch_id)
        if start and start == batch_id:
            self._merged(self._rows(start - self._fold, batch_id)).write.mode("overwrite").parquet(self._folder(start, -1))
            # a replay of this batch folds the last fold once more
            delete_folder(self._spark, f"{self.path}/fold={start - 2 * self._fold}")
        folder = self._folder(start, batch_id)
        rows.select(*self._schema.fieldNames()).write.mode("overwrite").parquet(folder)
        return self._spark.read.schema(self._schema).parquet(folder)

    def before(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """What the batches before ``batch_id`` amount to, of the keys of ``rows``. The batch must have been put."""
        kept = self._rows(self._start(batch_id), batch_id)
        return self._merged(kept.join(rows.select(*self._key), self._key, "left_semi"))

    def _start(self, batch_id: int) -> int:
        return batch_id // self._fold * self._fold

    def _folder(self, start: int, batch_id: int) -> str:
        return f"{self.path}/fold={start}/{BATCH}={batch_id}"

    def _merged(self, rows: DataFrame) -> DataFrame:
        return self._merge(rows).select(*self._schema.fieldNames())

    def _rows(self, start: int, until: int) -> DataFrame:
        """The fold that holds what was before ``start``, and the batches from there to ``until``."""
        schema = T.StructType([*self._schema.fields, T.StructField(BATCH, T.IntegerType())])
        folders = [self._folder(start, n) for n in ([-1] if start else []) + list(range(start, until))]
        if not folders:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).option("basePath", f"{self.path}/fold={start}").parquet(*folders)
