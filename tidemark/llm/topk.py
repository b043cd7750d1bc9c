"""Exact top-k search by inner product, with a KD-tree for each shard of vectors.

Trees split at the median of the widest component and keep tight bounding boxes.
The inner product of a query with any point of a box is at most the sum over
components of the larger product with the box's ends; a traversal takes the box
with the highest such bound first and ends once no bound reaches the k-th score.

Points are dealt to shards by median splits as well, fitted on a bounded sample, so
that shards have tight boxes. A query searches its home shard first and carries the
k-th score found there; it is sent on only to shards of cells whose box can reach it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import new_run_folder

K = 5
SCALE = 256
SHARD_POINTS = 8_192
LEAF_POINTS = 256
QUERY_BLOCK = 4_096
#: Most cells that points are dealt to, and rows of the sample for each that splits are
#: fitted on. A cell with more than ``SHARD_POINTS`` points has several shards.
MOST_CELLS = 1_024
SAMPLE_A_CELL = 32


def quantised(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """``id`` and ``point``, floor(256 x) of each component, of rows that take part.

    Rows without an id, null vectors and those with a null or non-finite component
    do not. Repeated rows are rows.
    """
    usable = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    point = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    kept = rows.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & usable)
    return kept.select(F.col(id_col).cast("long").alias("id"), point.alias("point"))


def _matrix(points: pa.ChunkedArray) -> np.ndarray:
    """Points as rows, filled up with zeros where they differ in length."""
    rows = [np.asarray(p, np.int64) for p in points.to_pylist()]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


class KdTree:
    """Nodes in preorder: box ends, range of points and, for inner nodes, the right child."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF_POINTS) -> None:
        order = np.arange(len(ids))
        low, high, first, stop, right = [], [], [], [], []

        def build(a: int, b: int) -> None:
            own = points[order[a:b]]
            node = len(low)
            low.append(own.min(0))
            high.append(own.max(0))
            first.append(a)
            stop.append(b)
            right.append(0)
            spread = high[node] - low[node]
            if b - a <= leaf or not spread.any():
                return
            middle = (b - a) // 2
            cut = np.argpartition(own[:, int(spread.argmax())], middle, kind="introselect")
            order[a:b] = order[a:b][cut]
            build(a, a + middle)
            right[node] = len(low)
            build(a + middle, b)

        build(0, len(ids))
        self.ids, self.points = ids[order], points[order]
        self.low, self.high = np.array(low), np.array(high)
        self.first, self.stop, self.right = (np.array(x, np.int64) for x in (first, stop, right))

    def search(
        self, query_ids: np.ndarray, queries: np.ndarray, reached: np.ndarray, k: int
    ) -> list[list[tuple[int, int]]]:
        """For each query the (score, -id) of its k best that are no worse than ``reached``."""
        common = min(queries.shape[1], self.points.shape[1])
        queries, points = queries[:, :common], self.points[:, :common]
        low, high = self.low[:, :common], self.high[:, :common]
        largest = max(1, int(np.abs(queries).max(initial=0))) * max(1, int(np.abs(points).max(initial=0)))
        if largest * max(1, common) < 1 << 53:  # exact as doubles, and fast
            queries, points, low, high = (x.astype(np.float64) for x in (queries, points, low, high))
        bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
        out = []
        for row, own in enumerate(query_ids.tolist()):
            best: list[tuple[int, int]] = []
            floor = reached[row]
            bound = bounds[row]
            open_nodes = [(-bound[0], 0)]
            while open_nodes:
                limit, node = heapq.heappop(open_nodes)
                if -limit < floor:
                    break
                if self.right[node]:
                    for child in (node + 1, int(self.right[node])):
                        if bound[child] >= floor:
                            heapq.heappush(open_nodes, (-bound[child], child))
                    continue
                a, b = int(self.first[node]), int(self.stop[node])
                scores = points[a:b] @ queries[row]
                near = np.flatnonzero((scores >= floor) & (self.ids[a:b] != own))
                best += [(int(scores[i]), -int(self.ids[a + i])) for i in near]
                if len(best) > k:
                    best = heapq.nlargest(k, best)
                if len(best) == k:
                    floor = max(floor, min(best)[0])
            out.append(sorted(best, reverse=True))
        return out


class Splits:
    """Cells by median splits of the widest component; near cells have near numbers."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        self.width = sample.shape[1]
        self.cells = 0
        #: component, cut, left and right child of inner nodes; a cell as -1 - number
        self.nodes: list[tuple[int, int, int, int]] = []
        self.root = self._build(sample, cells)

    def _build(self, own: np.ndarray, cells: int) -> int:
        if cells > 1 and len(own) > 1:
            axis = int((own.max(0) - own.min(0)).argmax()) if self.width else 0
            values = np.sort(own[:, axis]) if self.width else np.zeros(1, np.int64)
            cut = int(values[len(own) * (cells // 2) // cells])
            if cut == values[0]:  # ties: the next value, if there is one
                cut = int(next(iter(values[values > cut]), cut))
            left = own[:, axis] < cut if self.width else np.zeros(len(own), bool)
            if left.any():
                node = len(self.nodes)
                self.nodes.append((axis, cut, 0, 0))
                children = (self._build(own[left], cells // 2), self._build(own[~left], cells - cells // 2))
                self.nodes[node] = (axis, cut, *children)
                return node
        self.cells += 1
        return -self.cells

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point; missing components are zero."""
        missing = self.width - points.shape[1]
        if missing > 0:
            points = np.pad(points, ((0, 0), (0, missing)))
        out = np.empty(len(points), np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
                continue
            axis, cut, left, right = self.nodes[node]
            low = points[rows, axis] < cut
            todo += [(left, rows[low]), (right, rows[~low])]
        return out


def _with_cells(points: DataFrame, splits: Splits) -> DataFrame:
    """``id``, ``point`` and ``cell``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = pa.array(splits.cell_of(_matrix(batch.column(1))), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=["id", "point", "cell"])

    return points.select("id", "point").mapInArrow(run, "id long, point array<long>, cell long")


def _cell_boxes(points: DataFrame, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the box around each cell's points, filled up with zeros like the points.

    Components are reduced in Spark; one row for each cell and component comes back. A
    cell without points has a box that no query reaches.
    """
    ends = (
        points.select("cell", F.posexplode("point").alias("at", "x"))
        .groupBy("cell", "at")
        .agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("n"))
        .collect()
    )
    counts = dict(points.groupBy("cell").count().collect())
    width = max((r["at"] + 1 for r in ends), default=0)
    low, high = np.zeros((cells, width)), np.zeros((cells, width))
    for cell, at, least, most, n in ends:
        filled = n < counts[cell]  # shorter points are zero here
        low[cell, at] = min(least, 0) if filled else least
        high[cell, at] = max(most, 0) if filled else most
    return low, high


def _with_visits(
    asked: DataFrame, low: np.ndarray, high: np.ndarray, offsets: list[int], parts: list[int]
) -> DataFrame:
    """``shards`` that may hold a score as high as ``reached``, all but the home shard."""
    names = ["id", "point", "block", "home", "reached", "shards"]
    shards = [np.arange(a, a + n) for a, n in zip(offsets, parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                queries = _matrix(part.column(1)).astype(np.float64)
                common = min(queries.shape[1], low.shape[1])
                q, a, b = queries[:, :common], low[:, :common], high[:, :common]
                bounds = np.maximum(q, 0) @ b.T + np.minimum(q, 0) @ a.T
                # more than sums of doubles can be off by
                slack = 1e-9 * (np.abs(q) @ np.maximum(np.abs(a), np.abs(b)).T) + 1e-9
                reached = [-np.inf if r is None else r for r in part.column(4).to_pylist()]
                near = bounds + slack >= np.array(reached, np.float64)[:, None]
                homes = part.column(3).to_pylist()
                lists = [
                    [s for cell in np.flatnonzero(row) for s in shards[cell].tolist() if s != home]
                    for row, home in zip(near, homes)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lists, pa.list_(pa.int64()))], names=names
                )

    return asked.select(*names[:5]).mapInArrow(
        run, "id long, point array<long>, block long, home long, reached long, shards array<long>"
    )


def _blocks(counts: list[int], size: int) -> tuple[list[int], list[int]]:
    """First block and number of blocks of each cell's queries; small neighbours share one."""
    first, parts, block, filled = [], [], 0, 0
    for n in counts:
        if filled and filled + n > size:
            block, filled = block + 1, 0
        first.append(block)
        parts.append(max(1, -(-n // size)))
        if n > size:
            block, filled = block + parts[-1], 0
        else:
            filled += n
    return first, parts


_TREE = (
    "shard long, ids binary, points binary, width int, low binary, high binary, "
    "first binary, stop binary, right binary"
)
_LONGS = ["ids", "first", "stop", "right"]
_MATRICES = ["points", "low", "high"]


def _plant(table: pa.Table) -> pa.Table:
    tree = KdTree(table["id"].to_numpy(), _matrix(table["point"]))
    packed = {n: [getattr(tree, n).astype(np.int64).tobytes()] for n in _LONGS + _MATRICES}
    row = {"shard": [table["shard"][0].as_py()], **packed}
    row["width"] = pa.array([tree.points.shape[1]], pa.int32())
    return pa.table({c.split()[0]: row[c.split()[0]] for c in _TREE.split(", ")})


def _unpack(row: dict) -> KdTree:
    tree = KdTree.__new__(KdTree)
    for name in _LONGS:
        setattr(tree, name, np.frombuffer(row[name], np.int64))
    for name in _MATRICES:
        values = np.frombuffer(row[name], np.int64)
        rows = len(tree.ids) if name == "points" else len(tree.first)
        setattr(tree, name, values.reshape(rows, row["width"]))
    return tree


def _searched(pairs: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """The k best of each query (``shard``, ``block``, ``id``, ``point``, ``reached``) in a shard."""

    def search(tree: pa.Table, queries: pa.Table) -> pa.Table:
        found = ([], [], [])
        if tree.num_rows and queries.num_rows:
            ids = queries["id"].to_numpy()
            # no score yet: below all
            reached = np.array([-np.inf if r is None else r for r in queries["reached"].to_pylist()])
            hits = _unpack(tree.to_pylist()[0]).search(ids, _matrix(queries["point"]), reached, k)
            for query, best in zip(ids.tolist(), hits):
                for score, minus_id in best:
                    for column, value in zip(found, (query, -minus_id, score)):
                        column.append(value)
        names = ["query_id", "vec_id", "score"]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, found)})

    meetings = pairs.select(F.col("shard").alias("at"), F.col("block").alias("with")).distinct()
    dealt = trees.join(meetings, F.col("shard") == F.col("at")).withColumnRenamed("with", "block")
    return (
        dealt.groupBy("shard", "block")
        .cogroup(pairs.groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, vec_id long, score long")
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = K
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: the k highest scores of each query.

    Scores are integer inner products of quantised vectors; equal ones are ranked
    by the smaller id. A query's candidates are all vectors but those with its id;
    it gets fewer than k if there are fewer. Vectors of unequal length are compared
    as if filled up with zeros. A repeated candidate has a place for each of its rows; of
    several vectors with a query's id the smallest is the query, asked once. Scores have
    to fit into 64 bits.

    Shards and blocks of queries have a bounded size; a block meets a shard only if one
    of its queries may find a better score there. Points, trees, the answers of home
    shards and the shards to visit are written to the shared folder. The driver holds
    splits, boxes and counts of at most ``MOST_CELLS`` cells, fitted on a sample of at
    most ``MOST_CELLS * SAMPLE_A_CELL`` rows; every row is searched.
    """
    spark = rows.sparkSession
    folder = new_run_folder(spark, "topk")

    def written(part: DataFrame, name: str) -> DataFrame:
        part.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    plain = written(quantised(rows, id_col, vector), "points")
    cells = min(MOST_CELLS, max(1, -(-plain.count() // SHARD_POINTS)))
    sample = np.zeros((0, 0), np.int64)
    if cells > 1:
        taken = plain.orderBy(F.xxhash64("id"), "id", "point").limit(cells * SAMPLE_A_CELL)
        sample = _matrix(taken.toArrow()["point"])
    splits = Splits(sample, cells)
    points = written(_with_cells(plain, splits), "cells")
    held = dict(points.groupBy("cell").count().collect())
    parts = [max(1, -(-held.get(c, 0) // SHARD_POINTS)) for c in range(splits.cells)]
    offsets = [sum(parts[:c]) for c in range(splits.cells)]

    def dealt(first: list[int], sizes: list[int], by: Column) -> Column:
        """One of the cell's numbers, by hash."""
        start, size = (F.get(F.lit(x).cast("array<long>"), F.col("cell").cast("int")) for x in (first, sizes))
        return start + F.pmod(F.xxhash64(by), size)

    # by row, so that repeated rows are spread as well
    shard = dealt(offsets, parts, F.monotonically_increasing_id())
    trees = written(points.withColumn("shard", shard).groupBy("shard").applyInArrow(_plant, _TREE), "trees")

    one = quantised(queries, id_col, vector).groupBy("id").agg(F.min("point").alias("point"))
    asked = written(_with_cells(one, splits), "asked")
    asking = dict(asked.groupBy("cell").count().collect())
    blocks = _blocks([asking.get(c, 0) for c in range(splits.cells)], QUERY_BLOCK)
    asked = asked.select(
        "id", "point", dealt(*blocks, F.concat_ws(" ", "id", F.lit("block"))).alias("block"),
        dealt(offsets, parts, F.col("id")).alias("home"),
    )
    first = asked.select(
        F.col("home").alias("shard"), "block", "id", "point", F.lit(None).cast("long").alias("reached")
    )
    at_home = written(_searched(first, trees, k), "home")
    kth = at_home.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).alias("reached")
    )
    known = asked.join(kth, asked["id"] == kth["query_id"], "left")
    boxes = _cell_boxes(points, splits.cells)
    visits = written(_with_visits(known, *boxes, offsets, parts), "visits")
    others = visits.select(F.explode("shards").alias("shard"), "block", "id", "point", "reached")
    found = at_home.unionByName(_searched(others, trees, k))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
