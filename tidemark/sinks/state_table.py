"""The newest row of every key, in a bucketed Spark table.

The table is partitioned by the bucket of the key, which is the bucket that Spark
itself puts the key in. Both together let a rewrite name the buckets it replaces
(dynamic partition overwrite) and let joins on the key read the table without a
shuffle. A key never changes its bucket. Files are sorted by event time, so a bound on
it skips row groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import TableSpec

SLOT = "_slot"


class StateTable:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, buckets: int):
        if buckets < 1:
            raise ValueError("a state table needs a bucket")
        self.spark, self.path, self.spec, self.buckets = spark, path, spec, buckets
        fields = [*spec.flat_schema().fields, T.StructField(SLOT, T.IntegerType())]
        nothing = spark.createDataFrame([], T.StructType(fields)).write.mode("ignore")
        nothing.partitionBy(SLOT).parquet(path)
        self.name = f"tidemark_{spec.name}_{hashlib.md5(path.encode()).hexdigest()[:16]}"

    def slot(self) -> Column:
        """The bucket of a key, as Spark's bucketed writer numbers it."""
        return F.pmod(F.hash(self.spec.key), F.lit(self.buckets))

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows dealt out by key so that a task has rows of one bucket, and a bucket as many tasks as Spark's shuffles allow."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return rows.repartition(self.buckets * max(1, -(-tasks // self.buckets)), self.spec.key)

    def with_slot(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.spec.flat_schema().fieldNames(), self.slot().alias(SLOT))

    def _open(self) -> str:
        """Make the table known to this session, with the partitions that are there now."""
        if not self.spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spec.flat_schema())
            order = f"SORTED BY (`{self.spec.event_time}`)" if self.spec.event_time else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {SLOT} INT) USING parquet "
                f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({SLOT}) "
                f"CLUSTERED BY (`{self.spec.key}`) {order} INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
            )
        self.spark.catalog.recoverPartitions(self.name)
        self.spark.catalog.refreshTable(self.name)
        return self.name

    def rows(self) -> DataFrame:
        """Every key's row, with its slot."""
        return self.spark.table(self._open())

    def fill(self, rows: DataFrame) -> None:
        """Put ``rows``, which are dealt out, into the empty table."""
        self.with_slot(rows).write.mode("overwrite").insertInto(self._open())

    def replace(self, rows: DataFrame, slots: Iterable[int]) -> None:
        """Put ``rows``, which lie by slot in files, in place of everything in ``slots``; other slots are not touched."""
        name = self._open()
        rows.select(*self.spec.flat_schema().fieldNames(), SLOT).write.mode("overwrite").insertInto(name)
        filled = {r[0] for r in rows.select(SLOT).distinct().collect()}  # at most one a bucket
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in self.spec.flat_schema())
        for slot in sorted(set(slots) - filled):
            self.spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({SLOT} = {slot}) SELECT {nothing} WHERE false")
