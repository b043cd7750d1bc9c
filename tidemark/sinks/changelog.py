"""The change log of one table, the state it is folded into, and reads over both.

Layout below the root folder::

    log/ckpt=<checkpoint version>/batch_id=<n>/valid=<0|1>/   appended changes
    state/                                                    bucketed table, one row per key
    folds/fold=<n>/                                           which batches a fold holds
    staged/fold=<n>/                                          rows of an unfinished fold

A batch owns its folder, so writing it again replaces it. The checkpoint version
is part of the path because batch numbers restart with a new checkpoint. Versions
decide, so a batch that is folded and read again changes nothing.
"""

from __future__ import annotations

import re
import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_of_micros
from tidemark.functions.times import MICROS_PER_DAY, AsOf
from tidemark.operators.changes import TOMBSTONE, emit_where
from tidemark.operators.state import (
    expired_tombstone,
    latest_versions,
    live,
    merge_changes,
    offered_over,
)
from tidemark.schemas import TableSpec
from tidemark.session import delete_folder, new_run_folder
from tidemark.sinks.state_table import SLOT, StateTable

# Highest batch number of each checkpoint version.
Batches = Mapping[int, int]

BUCKETS = 64

# So many keys at most are sent to every executor, some 60 bytes each. More are left to Spark's joins.
SENT_KEYS = 2_000_000
_PLACE = re.compile(r"/ckpt=(\d+)/batch_id=(\d+)/valid=1/")


class ChangeLog:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, buckets: int = BUCKETS):
        self.spark = spark
        self.spec = spec
        self.root = root.rstrip("/")
        self._flat = spec.flat_schema()
        extras = [T.StructField(c, T.StringType()) for c in ("reason", "key_text", "value_text")]
        place = [
            T.StructField("ckpt", T.IntegerType()),
            T.StructField("batch_id", T.LongType()),
            T.StructField("valid", T.IntegerType()),
        ]
        self._log_schema = T.StructType([*self._flat.fields, *extras, *place])
        self._fold_schema = T.StructType(
            [
                T.StructField("ckpt", T.IntegerType()),
                T.StructField("through_batch", T.LongType()),
                T.StructField("slots", T.ArrayType(T.IntegerType())),
                T.StructField("done", T.IntegerType()),
                T.StructField("fold", T.IntegerType()),
            ]
        )
        self.table = StateTable(spark, f"{self.root}/state", spec, buckets)
        for name, schema, parts in (
            ("log", self._log_schema, ["ckpt", "batch_id", "valid"]),
            ("folds", self._fold_schema, ["fold"]),
        ):
            nothing = spark.createDataFrame([], schema).write.mode("ignore")
            nothing.partitionBy(*parts).parquet(f"{self.root}/{name}")

    # -- writing ---------------------------------------------------------

    def write_batch(self, triaged: DataFrame, batch_id: int, ckpt: int = 1) -> None:
        """Write one batch of triaged rows in a single pass.

        An empty batch is written as well: a replay that yields nothing must
        still replace what the first attempt left. Tombstones only follow a
        delete and are not kept.
        """
        reason = F.col("reason")
        names = [f.name for f in self._log_schema.fields if f.name not in ("ckpt", "batch_id")]
        marked = triaged.withColumn("valid", reason.isNull().cast("int"))
        kept = emit_where(marked, reason.isNull() | (reason != TOMBSTONE), names)
        (
            kept.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("valid")
            .parquet(f"{self.root}/log/ckpt={ckpt}/batch_id={batch_id}")
        )

    # -- reading the log -------------------------------------------------

    def _log(self) -> DataFrame:
        return self.spark.read.schema(self._log_schema).parquet(f"{self.root}/log")

    def changes(
        self,
        after: Batches | None = None,
        through: Batches | None = None,
        others: bool = False,
    ) -> DataFrame:
        """Valid changes; the bounds select whole batch folders.

        With ``through``, checkpoint versions it does not name are left out
        unless ``others`` is set.
        """
        return self._valid(self._log().filter(_in_range(after or {}, through, others)))

    def batch(self, batch_id: int, ckpt: int = 1) -> DataFrame:
        """Valid changes of one written batch, read from its own folder."""
        reader = self.spark.read.schema(self._log_schema).option("basePath", f"{self.root}/log")
        return self._valid(reader.parquet(self._batch_folder(ckpt, batch_id)))

    def _valid(self, rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("valid") == 1).select(*self._flat.fieldNames())

    def _batch_folder(self, ckpt: int, batch_id: int) -> str:
        return f"{self.root}/log/ckpt={ckpt}/batch_id={batch_id}"

    def _batches(self) -> list[tuple[int, int]]:
        """Checkpoint version and number of every batch with changes that is still in the log."""
        places = map(_PLACE.search, self._log().filter(F.col("valid") == 1).inputFiles())
        return sorted({(int(p[1]), int(p[2])) for p in places if p})

    def quarantine(self) -> DataFrame:
        return (
            self._log()
            .filter(F.col("valid") == 0)
            .select("ckpt", "batch_id", "partition", "offset", "reason", "key_text", "value_text")
        )

    def batches(self) -> dict[int, int]:
        """Highest batch with changes per checkpoint version."""
        return dict(self._batches())

    # -- state -----------------------------------------------------------

    def _folds(self) -> DataFrame:
        return self.spark.read.schema(self._fold_schema).parquet(f"{self.root}/folds")

    def folded(self) -> tuple[int, dict[int, int]]:
        """Number of the newest finished fold and the batches it holds; 0 if there is none."""
        rows = self._folds().filter("done = 1").collect()
        number = max((r["fold"] for r in rows), default=0)
        return number, {r["ckpt"]: r["through_batch"] for r in rows if r["fold"] == number}

    def _kept(self, since: AsOf = None) -> DataFrame:
        rows = self.table.rows().select(*self._flat.fieldNames())
        if since is not None and self.spec.event_time:
            rows = rows.filter(F.col(self.spec.event_time) >= as_of_micros(since))
        return rows

    def state(self, through: Batches | None = None, others: bool = False) -> DataFrame:
        """One row per key, deletes included: the folded state plus later batches.

        Batches a fold already holds stay in, whatever ``through`` says.
        """
        number, folded = self.folded()
        tail = self.changes(folded, through, others)
        if not number:
            return latest_versions(tail, self.spec.key)
        return merge_changes(self._kept(), tail, self.spec.key)

    def current(self) -> DataFrame:
        """Live rows."""
        return live(self.state())

    def recent(self, since: AsOf) -> DataFrame:
        """Live rows at or after an event time, as a filter on ``current()`` gives them.

        Of the folded state only the row groups from ``since`` on are read in full, the
        others for the keys and positions that decide whether a later batch wins. Only
        keys with a row from ``since`` on somewhere can be among them; they are looked up
        first, so that of state and log just their rows are shuffled.
        """
        number, folded = self.folded()
        key, tail = self.spec.key, self.changes(folded)
        found = self._since(tail, since).select(key)
        if number:
            found = found.unionByName(self._since(self._kept(since), since).select(key))
        keys = self._staged_keys(found)
        few = keys.count() <= SENT_KEYS
        if few:
            unnamed = tail.filter(F.col(key).isNull())  # no join finds these
            tail = tail.join(F.broadcast(keys), key, "left_semi").unionByName(unnamed)
        if number:
            kept = self._kept().join(F.broadcast(keys), key, "left_semi") if few else self._kept()
            rows = merge_changes(kept, tail, key, self._kept(since))
        else:
            rows = latest_versions(tail, key)
        return self._since(rows, since)

    def _staged_keys(self, keys: DataFrame) -> DataFrame:
        folder = new_run_folder(self.spark, "recent-keys")
        keys.write.parquet(folder)
        return self.spark.read.schema(keys.schema).parquet(folder)

    def _since(self, rows: DataFrame, since: AsOf) -> DataFrame:
        return live(rows).filter(F.col(self.spec.event_time) >= as_of_micros(since))

    def newest(self) -> int | None:
        """Event time of the newest live row, as the maximum over ``current()`` gives it.

        The newest time in state and log is no earlier, and mostly of about the same day.
        If no row of that day is live after all, every row is merged.
        """
        number, folded = self.folded()
        held, latest = live(self.changes(folded)), F.max(self.spec.event_time)
        if number:
            held = held.unionByName(live(self._kept()))
        top = held.agg(latest).first()[0]
        if top is None:
            return None
        found = self.recent(F.lit(top - MICROS_PER_DAY)).agg(latest).first()[0]
        return self.current().agg(latest).first()[0] if found is None else found

    def compacted(self, since: AsOf = None) -> DataFrame:
        """Live rows of the folded state alone; with ``since``, those at or after that event time.

        Changes after the fold are not seen.
        """
        return live(self._kept(since))

    def compact(self, through: Batches | None = None, expire_before: int | None = None) -> int:
        """Fold log batches into the state table and return the fold's number.

        Only buckets with a key that changes are rewritten. Without bounds the newest
        batch of every checkpoint version is left out, because its writer may still be
        at work. Tombstones stay in the state, so a late older change cannot bring a
        deleted key back, unless their version is below ``expire_before``, which no
        replay may reach.

        The new rows are staged in full before a bucket is replaced. A fold that died in
        between is finished by the next one, or by ``finish_fold``. Only the first fold
        writes into the table at once: nobody reads it before the fold is marked.
        """
        self.finish_fold()
        number, folded = self.folded()
        if through is None:
            through = {ckpt: n - 1 for ckpt, n in self.batches().items()}
        reached = {**folded, **{c: max(n, folded.get(c, n)) for c, n in through.items()}}
        tail = self.changes(folded, reached)
        if number or not self.table.rows().isEmpty():  # rows may be left of a first fold that died
            staged = f"{self.root}/staged/fold={number + 1}"
            slots = self._stage(tail, staged, expire_before)
            self._mark(number + 1, reached, slots, done=False)
            self.finish_fold()
        else:
            self.table.fill(self._unexpired(self._newest(tail), expire_before))
            self._mark(number + 1, reached, self._slots(self.table.rows()), done=True)
        return number + 1

    def _newest(self, tail: DataFrame) -> DataFrame:
        return latest_versions(self.table.dealt(tail), self.spec.key)

    @staticmethod
    def _unexpired(rows: DataFrame, before: int | None) -> DataFrame:
        return rows if before is None else rows.filter(~expired_tombstone(before))

    def _stage(self, tail: DataFrame, folder: str, expire_before: int | None) -> list[int]:
        """Write the new rows of the buckets that change; returns those buckets."""
        key, kept = self.spec.key, self.table.rows()
        newest = self._newest(tail)
        if self.folded()[0]:
            newest = self._winners(kept, newest, f"{folder}/winners")
            touched = newest.select(self.table.slot().alias(SLOT))
            if expire_before is not None:
                touched = touched.unionByName(kept.filter(expired_tombstone(expire_before)).select(SLOT))
            slots = self._slots(touched)
            old = kept.filter(F.col(SLOT).isin(slots)).drop(SLOT)
            rows = self.table.dealt(old.join(newest.select(key), key, "left_anti").select(newest.columns).unionByName(newest))
        else:
            slots, rows = None, newest  # what the table holds is of no fold
        rows = self.table.with_slot(self._unexpired(rows, expire_before))
        rows.write.mode("overwrite").partitionBy(SLOT).parquet(f"{folder}/rows")
        if slots is None:
            slots = sorted({*self._slots(kept), *self._slots(self._staged_rows(folder))})
        return slots

    def _winners(self, kept: DataFrame, newest: DataFrame, folder: str) -> DataFrame:
        """The rows of ``newest`` that the state lets in, written to a folder."""
        offered_over(kept, newest, self.spec.key).write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(self._flat).parquet(folder)

    @staticmethod
    def _slots(rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(SLOT).distinct().collect())  # at most one row a bucket

    def _staged_rows(self, folder: str) -> DataFrame:
        schema = T.StructType([*self._flat.fields, T.StructField(SLOT, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{folder}/rows")

    def finish_fold(self) -> bool:
        """Put a staged fold into the table. Doing it again gives the same table."""
        rows = self._folds().collect()  # the entries of the last folds, one a checkpoint version
        number = max((r["fold"] for r in rows), default=0)
        entries = [r for r in rows if r["fold"] == number]
        if not entries or entries[0]["done"]:
            return False
        staged = f"{self.root}/staged/fold={number}"
        self.table.replace(self._staged_rows(staged), entries[0]["slots"])
        reached = {r["ckpt"]: r["through_batch"] for r in entries}
        self._mark(number, reached, entries[0]["slots"], done=True)
        delete_folder(self.spark, staged)
        if number > 2:
            delete_folder(self.spark, f"{self.root}/folds/fold={number - 2}")
        return True

    def _mark(self, number: int, reached: Batches, slots: list[int], done: bool) -> None:
        entries = [(c, n, slots, int(done)) for c, n in reached.items()] or [(0, -1, slots, int(done))]
        schema = T.StructType(self._fold_schema.fields[:-1])
        rows = self.spark.createDataFrame(entries, schema).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.root}/folds/fold={number}")

    def drop_folded(self) -> int:
        """Delete the changes of batches that the state holds; returns how many batches.

        Quarantined messages stay.
        """
        number, held = self.folded()
        folders = [self._batch_folder(c, n) for c, n in self._batches() if n <= held.get(c, -1)]
        for folder in folders:
            delete_folder(self.spark, f"{folder}/valid=1")
        return len(folders)

    def maintain(
        self, batch_id: int, ckpt: int, every: int | None, drop_folded: bool, keep_ms: int | None = None
    ) -> None:
        """After a batch: every ``every`` batches, fold up to the one before.

        Not the batch itself, as a replay of it has to see the state before it.
        Tombstones older than ``keep_ms``, the longest a change may be late, expire.
        """
        if every and batch_id and (batch_id + 1) % every == 0:
            oldest = None if keep_ms is None else time.time_ns() // 1_000_000 - keep_ms
            self.compact({ckpt: batch_id - 1}, oldest)
            if drop_folded:
                self.drop_folded()


def _in_range(after: Batches, through: Batches | None, others: bool) -> Column:
    """Whether a batch is beyond ``after`` and, if given, not beyond ``through``; of folder names alone."""
    ckpt, batch = F.col("ckpt"), F.col("batch_id")
    wanted = F.lit(True)
    for version, n in after.items():
        wanted &= ~((ckpt == version) & (batch <= n))
    if through is not None:
        named = F.lit(False)
        for version, n in through.items():
            named |= (ckpt == version) & (batch <= n)
        if others:
            named |= ~ckpt.isin(*through) if through else F.lit(True)
        wanted &= named
    return wanted
