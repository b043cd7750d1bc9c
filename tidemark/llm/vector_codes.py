"""Vectors as short codes: product codebooks, trained with norm-of-sum bounds.

A vector is quantised to integers and cut into equal parts; each part is named by
the nearest entry of its codebook. Training assigns every part and moves each
entry to the mean of its parts, a fixed number of rounds; all of it is exact
integer arithmetic.

Assignments after the first keep, for each part and each group of entries, a lower
bound on the distance to the group and the round it was measured in. The
codebooks of all rounds stay at hand, so a bound of round s is worth in round t
what it was less the largest net displacement of the group's entries between the
two codebooks, however they wandered in between. Only groups whose bound does not
exceed the exact distance to the part's present entry are measured again.

The state of a round (points, codes, bounds, stamps) is a table in the shared
folder; the codebooks, whose size depends on no table, are all the driver sees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import bound_batches
from tidemark.session import delete_folder, new_run_folder

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Neighbouring entries that share a bound.
GROUP = 16
#: A bound is a whole number of at most this, two bytes.
LARGEST_BOUND = 65_535


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def quantised(vector: Column) -> Column:
    """Each component x as floor(256 * x)."""
    return F.transform(vector, lambda x: F.floor(256 * x.cast("double")))


# -- kernel ---------------------------------------------------------------


def matrix(column: pa.Array, parts: int, size: int, largest: int = 0) -> np.ndarray:
    """Points as rows x parts x components; short ones are padded with zeros.

    Doubles where all squared distances to points no larger than ``largest`` are exact in
    them, else whole numbers of any size.
    """
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), parts * size), np.int64)
    out[np.arange(parts * size) < lengths[:, None]] = values
    exact = 4 * max(largest, _largest(out)) ** 2 * max(1, size) < 1 << 52
    return out.reshape(len(lengths), parts, size).astype(np.float64 if exact else object)


def _largest(values: np.ndarray) -> int:
    return max(-int(values.min(initial=0)), int(values.max(initial=0)))


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, points x entries."""
    if points.dtype == object:
        apart = points[:, None, :] - entries[None, :, :]
        return (apart * apart).sum(-1)
    return ((points * points).sum(1)[:, None] - 2 * (points @ entries.T)) + (entries * entries).sum(1)


def _bound(squares: np.ndarray) -> np.ndarray:
    """Whole numbers no larger than the distances."""
    capped = np.minimum(squares, LARGEST_BOUND**2).astype(np.float64)
    return np.floor(np.sqrt(capped)).astype(np.uint16)


def _groups(entries: int) -> list[tuple[int, int]]:
    return [(a, min(a + GROUP, entries)) for a in range(0, entries, GROUP)]


class Assigner:
    """Nearest entries under the newest of a list of codebooks (parts x entries x components)."""

    def __init__(self, history: list[np.ndarray]):
        self.now = len(history) - 1
        self.largest = max(_largest(book) for book in history)
        self.newest = history[-1]
        self.groups = _groups(history[0].shape[1])
        # net displacement since each round: rounds x parts x groups, never too small
        self.moved = np.array([self._displaced(book) for book in history])

    def _book(self, points: np.ndarray) -> np.ndarray:
        return self.newest.astype(points.dtype)

    def _displaced(self, since: np.ndarray) -> list[list[float]]:
        apart = self.newest.astype(object) - since.astype(object)
        moved = np.sqrt((apart * apart).sum(-1).astype(np.float64)) * (1 + 1e-9)
        return [[moved[p, a:b].max(initial=0.0) for a, b in self.groups] for p in range(len(moved))]

    def first(self, points: np.ndarray):
        """Codes, bounds and stamps of points that have none yet."""
        rows, parts = points.shape[:2]
        book = self._book(points)
        codes = np.zeros((rows, parts), np.uint8)
        bounds = np.zeros((rows, parts, len(self.groups)), np.uint16)
        for p in range(parts):
            squares = _squares(points[:, p], book[p])
            codes[:, p] = squares.argmin(1)
            for g, (a, b) in enumerate(self.groups):
                bounds[:, p, g] = _without(squares[:, a:b], codes[:, p].astype(np.int64) - a)
        return codes, bounds, np.full(bounds.shape, self.now, np.uint8), rows * parts * book.shape[1]

    def again(self, points: np.ndarray, codes: np.ndarray, bounds: np.ndarray, stamps: np.ndarray):
        """Codes, bounds and stamps brought up to date; and how many distances that took."""
        codes, bounds, stamps = codes.copy(), bounds.copy(), stamps.copy()
        measured = codes.size
        books = self._book(points)
        for p in range(points.shape[1]):
            point, book, old = points[:, p], books[p], codes[:, p].astype(np.int64)
            own = point - book[old]
            best, code = (own * own).sum(1), old.copy()
            worth = bounds[:, p] - self.moved[stamps[:, p], p, np.arange(len(self.groups))]
            near = ~((worth > 0) & (worth * worth > best[:, None].astype(np.float64)))
            found = {}

            def measure(g: int, rows: np.ndarray) -> None:
                a, b = self.groups[g]
                squares = _squares(point[rows], book[a:b])
                nearest = squares.argmin(1)
                least = squares[np.arange(len(rows)), nearest]
                nearest = nearest + a
                closer = (least < best[rows]) | ((least == best[rows]) & (nearest < code[rows]))
                best[rows] = np.where(closer, least, best[rows])
                code[rows] = np.where(closer, nearest, code[rows])
                found.setdefault(g, []).append((rows, squares))

            for g in range(len(self.groups)):
                measure(g, np.flatnonzero(near[:, g]))
            # a bound leaves out the part's own entry: with another one, the old one counts again
            left = np.flatnonzero(code != old)
            for g in range(len(self.groups)):
                measure(g, left[(old[left] // GROUP == g) & ~near[left, g]])
            for g, scans in found.items():
                for rows, squares in scans:
                    bounds[rows, p, g] = _without(squares, code[rows] - self.groups[g][0])
                    stamps[rows, p, g] = self.now
                    measured += squares.size
            codes[:, p] = code
        return codes, bounds, stamps, measured

    def errors(self, points: np.ndarray, codes: np.ndarray) -> list[int]:
        """Squared distances to the named entries, summed over the parts, at most a long's largest."""
        total = np.zeros(len(points), points.dtype)
        book = self._book(points)
        for p in range(points.shape[1]):
            apart = points[:, p] - book[p][codes[:, p].astype(np.int64)]
            total = total + (apart * apart).sum(1)
        return [min(int(x), (1 << 63) - 1) for x in total.tolist()]


def _without(squares: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Bound on the distances of each row but that of its column ``own``, if it has it."""
    if not len(squares):
        return np.zeros(0, np.uint16)
    rest = squares.copy()
    rows = np.flatnonzero((own >= 0) & (own < squares.shape[1]))
    rest[rows, own[rows]] = LARGEST_BOUND**2
    return _bound(rest.min(1))


def moved_entries(book: np.ndarray, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> np.ndarray:
    """The codebook with each used entry at the floor of its parts' mean."""
    book = book.copy()
    for (part, entry), (count, total) in sums.items():
        book[part, entry] = [t // count for t in total]
    return book


# -- jobs -----------------------------------------------------------------


def _state_type(rows: DataFrame) -> T.StructType:
    binary = [T.StructField(n, T.BinaryType()) for n in ("code", "bounds", "stamps")]
    return T.StructType([*rows.schema.fields, *binary])


def _packed(values: np.ndarray) -> pa.Array:
    flat = values.reshape(len(values), -1)
    width = flat.shape[1] * flat.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(flat), [None, pa.py_buffer(np.ascontiguousarray(flat).tobytes())]
    ).cast(pa.binary())


def _unpacked(column: pa.Array, kind: type, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _assigned(rows: DataFrame, history: list[np.ndarray], keep: bool) -> DataFrame:
    """Rows (``id``, ``label``, ``point``, state from the second time on) under the newest codebook.

    With ``keep`` the state for the next time, else ``id``, ``label``, ``code`` and ``error``.
    """
    parts, entries, size = history[0].shape
    groups = len(_groups(entries))
    again = "code" in rows.columns
    plain = rows.select("id", "label", "point")
    if keep:
        out = _state_type(plain)
    else:
        own = [plain.schema["id"], plain.schema["label"]]
        out = T.StructType([*own, T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(history)
        for batch in batches:
            points = matrix(batch["point"], parts, size, assigner.largest)
            if again:
                state = (
                    _unpacked(batch["code"], np.uint8, (parts,)),
                    _unpacked(batch["bounds"], np.uint16, (parts, groups)),
                    _unpacked(batch["stamps"], np.uint8, (parts, groups)),
                )
                codes, bounds, stamps, _ = assigner.again(points, *state)
            else:
                codes, bounds, stamps, _ = assigner.first(points)
            if keep:
                made = [batch["point"], _packed(codes), _packed(bounds), _packed(stamps)]
            else:
                made = [_packed(codes), pa.array(assigner.errors(points, codes), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], *made], names=out.fieldNames())

    return rows.mapInArrow(run, out)


def _sums(state: DataFrame, shape: tuple[int, int, int]) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and component sums of the parts of each used entry; each task sends one row an entry."""
    parts, entries, size = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), np.int64)
        for batch in batches:
            codes = _unpacked(batch["code"], np.uint8, (parts,))
            points = matrix(batch["point"], parts, size).astype(np.int64)
            for p in range(parts):
                np.add.at(counts[p], codes[:, p], 1)
                np.add.at(totals[p], codes[:, p], points[:, p])
        part, entry = np.nonzero(counts)
        values = [[int(counts[p, e]), *totals[p, e].tolist()] for p, e in zip(part, entry)]
        made = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(values, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(made, names=["part", "entry", "totals"])

    partial = state.select("point", "code").mapInArrow(run, "part int, entry int, totals array<long>")
    summed = (
        partial.select("part", "entry", F.posexplode("totals").alias("at", "value"))
        .groupBy("part", "entry", "at")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        .groupBy("part", "entry")
        .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("values"))
    )
    found = {}
    for row in summed.collect():  # as many rows as the codebooks have entries
        count, *total = (int(v["value"]) for v in row["values"])
        found[row["part"], row["entry"]] = (count, total)
    return found


def _seeds(points: DataFrame, parts: int, entries: int, size: int) -> np.ndarray:
    """The parts of the points with the smallest ids; of equal ids the smaller point first."""
    rows = points.orderBy(F.col("id").asc_nulls_last(), "point").limit(entries).select("point").collect()
    book = np.zeros((parts, len(rows), size), np.int64)
    for entry, row in enumerate(rows):
        flat = np.zeros(parts * size, np.int64)
        flat[: len(row["point"])] = row["point"]
        book[:, entry] = flat.reshape(parts, size)
    return book


def digest(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``id``, ``label``, ``code`` (a byte a part) and ``error`` of each usable row; the codebooks.

    Rows whose vector is null or holds a null or non-finite component are left out.
    Repeated rows are rows; a null id is kept and comes after all others among the
    first entries; an empty vector is all zeros. Vectors shorter than the longest one,
    or than a multiple of ``parts``, are taken to go on with zeros. Other columns,
    whatever their names, are not read. With fewer rows than ``entries`` the codebooks
    have fewer entries, with none there are no rows. Components beyond a long's range
    (x over 3.6e16) count as its ends, errors beyond it as its largest.
    """
    if entries > 256 or rounds > 255:
        raise ValueError("codes and stamps are bytes: at most 256 entries and 255 rounds")
    spark = rows.sparkSession
    bound_batches(spark)
    points = rows.filter(usable(F.col(vector))).select(
        F.col(id_col).alias("id"), F.col(label).alias("label"), quantised(F.col(vector)).alias("point")
    )
    width = points.agg(F.max(F.size("point"))).first()[0] or 0
    size = -(-width // parts)
    history = [_seeds(points, parts, entries, size)]
    if not history[0].shape[1]:
        empty = points.select("id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.limit(0), history[0]
    folder = new_run_folder(spark, "codes")
    state = points
    for n in range(rounds):
        _assigned(state, history, keep=True).write.parquet(f"{folder}/{n}")
        state = spark.read.parquet(f"{folder}/{n}")
        if n:
            delete_folder(spark, f"{folder}/{n - 1}")
        history.append(moved_entries(history[-1], _sums(state, history[-1].shape)))
    return _assigned(state, history, keep=False), history[-1]


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors summed over rows of the same label, nulls together.

    Summed before the shuffle; the join is Spark's to broadcast or to split.
    """
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


def decoded(coded: DataFrame, book: np.ndarray) -> DataFrame:
    """``id`` and ``point``, the integers that each ``code`` stands for."""
    size = book.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _unpacked(batch["code"], np.uint8, (book.shape[0],))
            flat = book[np.arange(book.shape[0]), codes].reshape(len(codes), book.shape[0] * size)
            points = pa.array(flat.tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["id"], points], names=["id", "point"])

    schema = T.StructType([coded.schema["id"], T.StructField("point", T.ArrayType(T.LongType()))])
    return coded.select("id", "code").mapInArrow(run, schema)


SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS point
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS (
  SELECT vec_id, p, point[p * (len(point) // {PARTS}) + 1 : (p + 1) * (len(point) // {PARTS})] AS x
  FROM kept, (SELECT unnest(range({PARTS})) AS p)
), seed AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS e, vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES}
), book0 AS (SELECT p, e, x AS c FROM part JOIN seed USING (vec_id))
"""


def _round_sql(n: int) -> str:
    return f"""
, near{n} AS (
  SELECT vec_id, p, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT vec_id, p, e,
               list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d
        FROM part JOIN book{n} USING (p))
  GROUP BY vec_id, p
)"""


def _move_sql(n: int) -> str:
    return f"""
, mean{n} AS (
  SELECT p, e, list(v ORDER BY i) AS c
  FROM (SELECT p, e, i, floor(sum(v) / count(*))::BIGINT AS v
        FROM (SELECT p, e, unnest(range(len(x))) AS i, unnest(x) AS v FROM near{n} JOIN part USING (vec_id, p))
        GROUP BY p, e, i)
  GROUP BY p, e
), book{n + 1} AS (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN mean{n} m USING (p, e)
)"""


SQL += "".join(_round_sql(n) + _move_sql(n) for n in range(ROUNDS)) + _round_sql(ROUNDS) + f"""
, coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY vec_id
), digest AS (
  SELECT sha256(string_agg(v, ',' ORDER BY p, e)) AS codebooks_sha256
  FROM (SELECT p, e, array_to_string(c, ',') AS v FROM book{ROUNDS})
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""
