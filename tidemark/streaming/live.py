"""Broken references and leading customers, kept while changes stream in.

Both follow from two retraction feeds, of the children and of the parents, keyed by
parent: how many live children refer to it, and whether it is live itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidemark.config import PipelineConfig
from tidemark.streaming.jobs import BatchWriter, set_trigger
from tidemark.streaming.retractions import WEIGHT, use_rocksdb

_PLACE = "ckpt int, batch_id long"


def references(children: DataFrame, parents: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """Feeds as one stream: ``parent`` (a table), ``id``, and how its ``refs``, ``items`` and ``live`` change.

    ``parents`` maps a table's name to the children's column and the table's own feed.
    """
    quantity = F.coalesce("quantity", F.lit(0)).cast("long") * F.col(WEIGHT)
    zero = F.lit(0).cast("long")
    columns = F.array(*(F.struct(F.lit(n).alias("parent"), F.col(c).alias("id")) for n, (c, _) in parents.items()))
    refs = F.col(WEIGHT).cast("long").alias("refs")
    out = children.select(F.inline(columns), refs, quantity.alias("items"), zero.alias("live")).filter("id IS NOT NULL")
    for name, (_, feed) in parents.items():
        own = F.col(WEIGHT).cast("long").alias("live")
        out = out.unionByName(feed.select(F.lit(name).alias("parent"), "id", zero.alias("refs"), zero.alias("items"), own))
    return out


_ORPHANS = "parent string, id long, orders long"


def orphan_counts(rows: DataFrame) -> DataFrame:
    """How many orphans each parent that a batch touches has now: all its references, unless it is live."""
    sums = rows.groupBy("parent", "id").agg(F.sum("refs").alias("refs"), F.sum("live").alias("live"))
    return sums.select("parent", "id", F.when(F.col("live") == 0, F.col("refs")).otherwise(0).alias("orders"))


def _owned(path: str, ckpt: int) -> BatchWriter:
    """A batch owns its folder, so one that is done again replaces what it wrote."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{path}/ckpt={ckpt}/batch_id={batch_id}"
        )

    return write


def _start(
    rows: DataFrame, name: str, path: str, checkpoint: str, config: PipelineConfig, ckpt: int, now: bool, mode: str = "append"
) -> StreamingQuery:
    writer = rows.writeStream.queryName(f"{name} {checkpoint}").outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint).foreachBatch(_owned(path, ckpt))
    return set_trigger(writer, config, now).start()


def start_orphans(
    rows: DataFrame, path: str, checkpoint: str, config: PipelineConfig, ckpt: int = 1, available_now: bool = False
) -> StreamingQuery:
    """Keep the orphans of a stream of ``references`` in the folder ``path``."""
    use_rocksdb(rows.sparkSession)
    return _start(orphan_counts(rows), "orphans", path, checkpoint, config, ckpt, available_now, "update")


def read_orphans(spark: SparkSession, path: str, ckpt: int = 1) -> DataFrame:
    """``missing_parent``, ``parent_id`` and the number of live ``orders`` that refer to it, from each parent's newest count."""
    schema = f"{_ORPHANS}, {_PLACE}"
    rows = spark.read.schema(schema).parquet(path).filter(F.col("ckpt") == ckpt)
    sums = rows.groupBy(F.col("parent").alias("missing_parent"), F.col("id").alias("parent_id"))
    return sums.agg(F.max_by("orders", "batch_id").alias("orders")).filter("orders > 0")


# -- leaders --------------------------------------------------------------


class Leaders(StatefulProcessor):
    """Keeps the ``k`` leading parents of a slot and a reserve behind them.

    All totals of the slot are kept as well. ``floor`` bounds those outside the
    reserve, so as long as ``k`` in it stand above the floor they are the leaders; only
    when losses use the reserve up are the totals gone through to fill it again.
    """

    def __init__(self, k: int, reserve: int):
        self.k, self.size = k, k + reserve

    def init(self, handle) -> None:
        self._totals = handle.getMapState("totals", "id long", "refs long, items long, live long")
        self._top = handle.getValueState("top", "ids array<long>, floor_refs long, floor_id long")

    @staticmethod
    def _rank(id: int, totals: tuple[int, int, int]) -> tuple[int, int]:
        """Ascending order of leaders: most references first, then the smaller id."""
        return -totals[0], id

    def _counts(self, totals: tuple[int, int, int] | None) -> bool:
        return totals is not None and totals[0] > 0 and totals[2] > 0

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        changed: dict[int, list[int]] = {}
        for row in rows:
            sums = changed.setdefault(row["id"], [0, 0, 0])
            for i, name in enumerate(("refs", "items", "live")):
                sums[i] += row[name]
        first = not self._top.exists()
        ids, *floor = ([], None, None) if first else self._top.get()
        floor = None if floor[0] is None else tuple(floor)  # the best rank outside
        held = {i: self._totals.getValue((i,)) for i in ids}
        before = sorted(self._rank(i, t) + (t[1],) for i, t in held.items())[: self.k]
        for id, sums in changed.items():
            old = self._totals.getValue((id,)) if self._totals.containsKey((id,)) else (0, 0, 0)
            totals = tuple(a + b for a, b in zip(old, sums))
            if any(totals):
                self._totals.updateValue((id,), totals)
            elif any(old):
                self._totals.removeKey((id,))
            held.pop(id, None)
            if self._counts(totals):
                held[id] = totals
        ranked = sorted(self._rank(i, t) for i, t in held.items())
        sure = [r for r in ranked if floor is None or r <= floor]
        if len(sure) < self.k and floor is not None:
            every = ((k[0], tuple(t)) for k, t in self._totals.iterator())
            ranked = sorted(self._rank(i, t) for i, t in every if self._counts(t))
            sure, floor = ranked, None
        kept, beyond = sure[: self.size], sure[self.size :]
        # the others of the reserve that are behind the floor leave it and do not move it
        floor = min((*beyond[:1], *([floor] if floor else [])), default=None)
        self._top.update(([i for _, i in kept], *(floor or (None, None))))
        leaders = [(r, i, self._totals.getValue((i,))[1]) for r, i in kept[: self.k]]
        if leaders != [tuple(b) for b in before] or first:
            for at, (refs, id, items) in enumerate(leaders):
                yield Row(slot=key[0], at=at, id=id, refs=-refs, items=items)
            yield Row(slot=key[0], at=len(leaders), id=None, refs=None, items=None)

    def close(self) -> None:
        pass


_LEADERS = "slot int, at int, id long, refs long, items long"
_STEPS = "slot int, id long, refs long, items long, live long"
#: Rows that a task holds at most beyond one a parent.
_PENDING = 1_000_000


def _sums(table: pa.Table) -> pa.Table:
    names = ("refs", "items", "live")
    summed = table.group_by(["slot", "id"]).aggregate([(n, "sum") for n in names])
    return summed.select(["slot", "id", *(f"{n}_sum" for n in names)]).rename_columns(["slot", "id", *names])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each parent of a task."""
    held, pending, size = [], [], 0
    for batch in batches:
        pending.append(batch)
        size += batch.num_rows
        if size >= _PENDING:
            held, pending, size = _sums(pa.Table.from_batches(held + pending)).to_batches(), [], 0
    if held or pending:
        yield from _sums(pa.Table.from_batches(held + pending)).to_batches(max_chunksize=10_000)


def start_leaders(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    config: PipelineConfig,
    k: int = 50,
    reserve: int = 50,
    slots: int = 16,
    ckpt: int = 1,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the leading parents of a stream of ``references`` to one table in the folder ``path``."""
    use_rocksdb(rows.sparkSession)
    slot: Column = F.pmod(F.hash("id"), F.lit(slots)).alias("slot")
    steps = rows.select(slot, "id", "refs", "items", "live")
    # the orders of a parent are added up before they come to its slot's one task
    keyed = steps.repartition("slot", "id").mapInArrow(_summed, _STEPS).groupBy("slot")
    lists = keyed.transformWithState(Leaders(k, reserve), _LEADERS, "append", "none")
    return _start(lists, "leaders", path, checkpoint, config, ckpt, available_now)


def read_leaders(spark: SparkSession, path: str, k: int = 50, ckpt: int = 1) -> DataFrame:
    """``id``, ``total_orders`` and ``total_items`` of the ``k`` leaders, from each slot's newest list."""
    schema = f"{_LEADERS}, {_PLACE}"
    rows = spark.read.schema(schema).parquet(path).filter(F.col("ckpt") == ckpt)
    newest = Window.partitionBy("slot").orderBy(F.desc("batch_id"))
    last = rows.withColumn("_rank", F.rank().over(newest)).filter("_rank = 1 AND id IS NOT NULL")
    named = last.select("id", F.col("refs").alias("total_orders"), F.col("items").alias("total_items"))
    return named.orderBy(F.desc("total_orders"), "id").limit(k)
