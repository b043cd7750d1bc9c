"""Nearest neighbours by largest inner product, from a few stable projections.

Vectors are scaled by the largest norm and completed to unit length, queries scaled
to unit length, so that the largest inner product is the smallest distance. Gaussian
(2-stable) projections to a few dimensions follow: a squared projected distance is
the squared distance times a chi-square variable with as many degrees of freedom.

Projected points lie in KD-trees. A search takes their leaves in ascending projected
distance and verifies the points on their original vectors. It stops at the projected
distance r where a point as near as the present k-th best would, with the certainty
asked for, have been projected nearer: chi-square(r^2 / d_k^2) >= certainty. So
each true neighbour is missed with a probability of at most 1 - certainty.

Points are dealt to cells of a KD-tree over a sample of projections, so cells have
tight boxes. A query searches its own cell first; of the other cells it visits those
whose box passes the test at the k-th distance found there. Every row is indexed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import bound_batches
from tidemark.session import new_run_folder

K = 20
DIMS = 8
#: Probability at which a search takes it that no neighbour is left.
CERTAINTY = 0.96
#: Points of a searched shard; a cell with more is dealt into several.
SHARD = 2048
LEAF = 128
#: Most cells, and rows of the sample for each that the splits are fitted on.
MOST_CELLS = 1024
SAMPLE_A_CELL = 32
#: Queries that are searched in a task at once.
BLOCK = 2048
SEED = 20_13
#: Squared distances of vectors of unit length are not told apart below this.
_SLACK = 1e-9


def chi_square_quantile(certainty: float, dims: int) -> float:
    """The value a chi-square variable with an even number of degrees stays below."""

    def below(x: float) -> float:
        term, total = 1.0, 0.0
        for i in range(dims // 2):
            total += term
            term *= x / 2 / (i + 1)
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while below(high) < certainty:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < certainty else (low, middle)
    return high


# -- trees ----------------------------------------------------------------


class KdTree:
    """Median splits of the widest side, tight boxes, at most ``leaf`` points a leaf."""

    def __init__(self, points: np.ndarray, leaf: int):
        order = np.arange(len(points))
        low, high, first, stop, right, split = [], [], [], [], [], []

        def build(a: int, b: int) -> int:
            node, part = len(low), points[order[a:b]]
            low.append(part.min(0))
            high.append(part.max(0))
            first.append(a)
            stop.append(b)
            right.append(0)
            split.append((0, 0.0))
            if b - a > leaf:
                side = int(np.argmax(high[node] - low[node]))
                middle = (b - a) // 2
                near = np.argpartition(part[:, side], middle)
                order[a:b] = order[a:b][near]
                split[node] = (side, float(part[near[middle], side]))
                build(a, a + middle)
                right[node] = build(a + middle, b)
            return node

        if len(points):
            build(0, len(points))
        self.order, self.points = order, points[order]
        self.low, self.high = np.array(low), np.array(high)
        self.first, self.stop, self.right, self.split = first, stop, right, split

    def leaves(self) -> list[int]:
        return [node for node, child in enumerate(self.right) if not child]

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf, by number, that each point falls into."""
        cells = np.zeros(len(points), np.int64)
        number = {node: i for i, node in enumerate(self.leaves())}
        todo = [(0, np.arange(len(points)))] if number else []
        while todo:
            node, rows = todo.pop()
            if node in number:
                cells[rows] = number[node]
                continue
            side, value = self.split[node]
            left = points[rows, side] < value
            todo += [(node + 1, rows[left]), (self.right[node], rows[~left])]
        return cells


def box_squares(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes, points x boxes."""
    out = np.zeros((len(points), len(low)))
    for side in range(points.shape[1]):
        x = points[:, side, None]
        out += np.maximum(np.maximum(low[:, side] - x, x - high[:, side]), 0) ** 2
    return out


class Search:
    """The rows of a shard that are nearest to queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projected: np.ndarray, norm: float, limit: float):
        self.tree = KdTree(projected, LEAF)
        self.ids, self.vectors = ids[self.tree.order], vectors[self.tree.order]
        self.norm, self.limit = norm, limit
        self.verified = 0

    def nearest(
        self, own: np.ndarray, queries: np.ndarray, projected: np.ndarray, k: int, reached: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query numbers, ids and scores of the ``k`` best found for each query.

        ``reached`` is a score that ``k`` others have. Every query takes the leaves in
        ascending distance of their boxes; those that are at the same leaf in a round
        are verified together.
        """
        tree, sizes = self.tree, np.sqrt((queries * queries).sum(1))
        scale = 1.0 / (sizes * self.norm)
        leaves = np.array(tree.leaves())
        boxes = box_squares(projected, tree.low[leaves], tree.high[leaves])
        order = np.argsort(boxes, axis=1, kind="stable")
        boxes = np.take_along_axis(boxes, order, axis=1)
        # products of a leaf at once tell, within their rounding, which rows can be among the best
        rounding = _SLACK * sizes * self.norm
        top = np.full((len(own), k), -np.inf)
        kth, near = reached.astype(np.float64), (projected * projected).sum(1)
        kept: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for turn in range(len(leaves)):
            far = self.limit * np.maximum(0, 2 - 2 * kth * scale) + _SLACK
            going = np.flatnonzero(boxes[:, turn] <= far)  # for the others the chi-square test holds
            at = order[going, turn]
            for leaf in np.unique(at).tolist():
                a, b = tree.first[leaves[leaf]], tree.stop[leaves[leaf]]
                asked, points = going[at == leaf], tree.points[a:b]
                squares = (points * points).sum(1) - 2 * (projected[asked] @ points.T) + near[asked, None]
                scores = queries[asked] @ self.vectors[a:b].T
                ripe = squares <= far[asked, None]
                self.verified += int(ripe.sum())
                scores[~ripe | (self.ids[a:b] == own[asked, None])] = -np.inf
                column, row = np.nonzero(scores >= (kth - rounding)[asked, None])
                kept.append((asked[column], row + a, scores[column, row]))
                top[asked] = np.partition(np.concatenate([top[asked], scores], axis=1), -k, axis=1)[:, -k:]
                kth[asked] = np.maximum(kth[asked], top[asked].min(1))
        asked, rows, scores = (np.concatenate(c) for c in zip(*kept))
        last = np.flatnonzero(np.isfinite(scores) & (scores >= (kth - rounding)[asked]))
        asked, rows = asked[last], rows[last]
        # by rows, so that equal vectors have equal scores
        scores = np.zeros(len(rows))
        for a, b in ((a, a + (1 << 14)) for a in range(0, len(rows), 1 << 14)):
            scores[a:b] = (self.vectors[rows[a:b]] * queries[asked[a:b]]).sum(1)
        best = np.lexsort((self.ids[rows], -scores, asked))
        asked, ids, scores = asked[best], self.ids[rows[best]], scores[best]
        place = np.arange(len(asked)) - np.searchsorted(asked, asked)
        return tuple(c[place < k] for c in (asked, ids, scores))


# -- jobs -----------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Whether a vector is there, all its components are finite, and one is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _doubles(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; those shorter than the longest go on with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _blob(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), width)


def _packed(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(values)], pa.binary())


class Projection:
    """Projections of points and queries, and the cells they fall into."""

    def __init__(self, width: int, norm: float, dims: int):
        self.width, self.norm, self.dims = width, norm, dims
        self.directions = np.random.default_rng(SEED).standard_normal((width + 1, dims))
        self.cells: KdTree | None = None

    def of(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        lengths = np.sqrt((vectors * vectors).sum(1))
        unit = vectors / (lengths[:, None] if queries else self.norm)
        rest = np.sqrt(np.maximum(0, 1 - (lengths / self.norm) ** 2)) * (not queries)
        whole = np.concatenate([unit, rest[:, None]], axis=1)
        # by rows, so that equal vectors have equal projections
        return np.stack([(whole * d).sum(1) for d in self.directions.T], axis=1)


def _projected(rows: DataFrame, projection: Projection, queries: bool) -> DataFrame:
    """``id``, ``vector``, ``place`` (its projection), ``cell`` and ``row``, a number to deal rows by."""
    schema = T.StructType(
        [
            *(T.StructField("id", T.LongType()), rows.schema["vector"]),
            *(T.StructField("place", T.BinaryType()), T.StructField("cell", T.IntegerType())),
            T.StructField("row", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = projection.of(_doubles(batch["vector"], projection.width), queries)
            cells = projection.cells.cell_of(places) if projection.cells else np.zeros(len(places))
            made = [_packed(places), pa.array(cells, pa.int32()), batch["row"]]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["vector"], *made], names=schema.fieldNames())

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    return numbered.select("id", "vector", "row").mapInArrow(run, schema)


def _boxes(points: DataFrame, dims: int) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Rows, lowest and highest corner of each cell that has rows; there are at most ``MOST_CELLS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            cells, places = batch["cell"].to_numpy(), _blob(batch["place"], dims)
            for cell in np.unique(cells).tolist():
                own = places[cells == cell]
                count, low, high = seen.get(cell, (0, np.inf, -np.inf))
                seen[cell] = (count + len(own), np.minimum(low, own.min(0)), np.maximum(high, own.max(0)))
        made = [
            pa.array(list(seen), pa.int32()),
            pa.array([v[0] for v in seen.values()], pa.int64()),
            *(pa.array([v[i].tolist() for v in seen.values()], pa.list_(pa.float64())) for i in (1, 2)),
        ]
        yield pa.RecordBatch.from_arrays(made, names=["cell", "count", "low", "high"])

    parts = points.select("cell", "place").mapInArrow(run, "cell int, count long, low array<double>, high array<double>")
    ends = [(F.min, "low"), (F.max, "high")]
    corners = (f(F.col(c)[i]).alias(f"{c}{i}") for f, c in ends for i in range(dims))
    rows = parts.groupBy("cell").agg(F.sum("count").alias("count"), *corners).collect()
    corner = lambda r, c: np.array([r[f"{c}{i}"] for i in range(dims)])
    return {r["cell"]: (r["count"], corner(r, "low"), corner(r, "high")) for r in rows}


_FOUND = "query long, query_id long, vec_id long, score double"


def _visits(queries: DataFrame, boxes: dict, limit: float, projection: Projection, first: bool) -> DataFrame:
    """The shards (``cell``, ``part``) that a query visits, a row each.

    The first time one shard of its own cell; then all others whose box passes the
    test at ``reached``, the score of its k-th best so far.
    """
    names = sorted(boxes)
    counts = {c: -(-boxes[c][0] // SHARD) for c in names}
    low, high = (np.array([boxes[c][i] for c in names]) for i in (1, 2))
    shards = [(i, c, part) for i, c in enumerate(names) for part in range(counts[c])]
    schema = T.StructType(
        [
            *(T.StructField(n, T.IntegerType()) for n in ("cell", "part")),
            *(T.StructField("id", T.LongType()), queries.schema["vector"], T.StructField("place", T.BinaryType())),
            *(T.StructField("row", T.LongType()), T.StructField("reached", T.DoubleType())),
        ]
    )
    kept = ["id", "vector", "place", "row", "reached"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _blob(batch["place"], projection.dims)
            squares = box_squares(places, low, high)
            home = squares.argmin(1)
            if not first:
                reached = np.array([-np.inf if r is None else r for r in batch["reached"].to_pylist()])
                vectors = _doubles(batch["vector"], projection.width)
                scale = 1 / (np.sqrt((vectors * vectors).sum(1)) * projection.norm)
                far = limit * np.maximum(0, 2 - 2 * reached * scale) + _SLACK
            for box, cell, part in shards:
                own = (home == box) & (part == 0)
                rows = np.flatnonzero(own if first else ~own & (squares[:, box] <= far))
                if len(rows):
                    sent = [batch[c].take(pa.array(rows)) for c in kept]
                    where = [pa.array(np.full(len(rows), x, np.int32)) for x in (cell, part)]
                    yield pa.RecordBatch.from_arrays([*where, *sent], names=schema.fieldNames())

    return queries.select(kept).mapInArrow(run, schema)


def _searched(visits: DataFrame, points: DataFrame, blocks: int, projection: Projection, limit: float, k: int) -> DataFrame:
    """What each visit finds. A task holds a shard and the queries of one block that visit it."""

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found = [[], [], [], []]
        if rows.num_rows and queries.num_rows:
            table = lambda t: (
                t["id"].to_numpy(),
                _doubles(t["vector"].combine_chunks(), projection.width),
                _blob(t["place"], projection.dims),
            )
            shard = Search(*table(rows), projection.norm, limit)
            ids, vectors, places = table(queries)
            reached = np.array([-np.inf if r is None else r for r in queries["reached"].to_pylist()])
            asked, near, scores = shard.nearest(ids, vectors, places, k, reached)
            found = [queries["row"].to_numpy()[asked], ids[asked], near, scores]
        kinds = [pa.int64()] * 3 + [pa.float64()]
        return pa.table({c.split()[0]: pa.array(v, t) for c, v, t in zip(_FOUND.split(", "), found, kinds)})

    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    asked = visits.withColumn("block", block)
    key, to = ["cell", "part", "block"], ["to_cell", "to_part", "to_block"]
    wanted = asked.select(key).distinct().toDF(*to)
    here = (F.col("cell") == F.col("to_cell")) & (F.col("part") == F.col("to_part"))
    dealt = points.join(wanted, here).select(*to, "id", "vector", "place")
    return dealt.groupBy(to).cogroup(asked.groupBy(key)).applyInArrow(search, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _sampled(places: DataFrame, rows: int, dims: int) -> np.ndarray:
    """Projections of the rows with the smallest hashes, a bounded sample."""
    taken = places.orderBy(F.xxhash64("id", "row"), "row").limit(rows).select("place").collect()
    return np.frombuffer(b"".join(bytes(r[0]) for r in taken), np.float64).reshape(len(taken), dims)


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    dims: int = DIMS,
    certainty: float = CERTAINTY,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: for each query the nearest rows found.

    Nearness is the largest inner product, in double precision. Every row with another
    id than the query's own is a candidate. Rows without an id, and vectors that are
    null, zero or hold a null or non-finite component, take no part. Repeated rows are
    rows: as candidates each has a place; a repeated query (same id and vector) is
    asked once, and an id with several vectors is asked with each. Equal scores go by
    id. Vectors shorter than the longest go on with zeros. Other columns are not read.
    Each true neighbour is found with a probability of ``certainty`` at least.

    The sample that cells are fitted on has at most ``MOST_CELLS * SAMPLE_A_CELL`` rows.
    """
    if dims % 2 or dims < 2:
        raise ValueError("the number of projections must be even")
    spark = rows.sparkSession
    bound_batches(spark)

    def plain(table: DataFrame) -> DataFrame:
        usable_rows = table.filter(F.col(id_col).isNotNull() & usable(F.col(vector)))
        return usable_rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vector"))

    points, asked = plain(rows), plain(queries).distinct()
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = points.agg(F.count("*").alias("n"), F.max(square).alias("norm"), F.max(F.size("vector")).alias("width")).first()
    widest = max(facts["width"] or 0, asked.agg(F.max(F.size("vector"))).first()[0] or 0)
    projection = Projection(widest, math.sqrt(facts["norm"] or 1.0), dims)
    limit = chi_square_quantile(certainty, dims)
    folder = new_run_folder(spark, "neighbours")
    cells = min(MOST_CELLS, -(-facts["n"] // SHARD))
    if cells > 1:
        sample = _sampled(_projected(points, projection, False), cells * SAMPLE_A_CELL, dims)
        projection.cells = KdTree(sample, -(-len(sample) // cells))

    def kept(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    points = kept(_projected(points, projection, False), "points")
    asked = kept(_projected(asked, projection, True), "queries")
    boxes = _boxes(points, dims)
    parts = F.lit(1)
    for cell, (count, _, _) in boxes.items():
        if count > SHARD:
            parts = F.when(F.col("cell") == cell, -(-count // SHARD)).otherwise(parts)
    points = points.withColumn("part", F.pmod(F.xxhash64("row"), parts.cast("long")).cast("int"))
    blocks = max(1, -(-asked.count() // BLOCK))
    if not boxes:
        empty = spark.createDataFrame([], _FOUND).withColumn("rank", F.lit(1))
        return empty.select("query_id", "rank", "vec_id", "score")
    visits = _visits(asked.withColumn("reached", F.lit(None).cast("double")), boxes, limit, projection, True)
    near = kept(_searched(visits, points, blocks, projection, limit, k), "near")
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    kth = near.withColumn("at", F.row_number().over(order)).filter(F.col("at") == k)
    kth = kth.select(F.col("query").alias("row"), F.col("score").alias("reached"))
    visits = _visits(asked.join(kth, "row", "left"), boxes, limit, projection, False)
    found = near.unionByName(_searched(visits, points, blocks, projection, limit, k))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
