"""Token counts that follow edits.

Each document keeps a segment tree over its pre-tokens, with code points and tokens
summed in every node. An edit finds the pre-tokens it touches by descending the
tree, encodes these anew together with the boundary context that decides where
tokens start, and updates the sums above them. The rest of the text is not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import lists, map_texts, slices
from tidemark.llm.bpe import CHUNK_BYTES, cut, pretoken_starts, slice_pieces, vocabulary

#: A pre-token ends by what stands up to this many code points after it.
LOOKAHEAD = 2
#: Code points after an edit that are encoded with it at first.
CONTEXT = 32


class SegmentTree:
    """Sums of code points and tokens over segments, in arrays of one heap each.

    A segment begins as a pre-token. Segments that an edit joins are put into the
    first of them, and the others left empty.
    """

    def __init__(self, sizes: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves = 1 << max(0, int(len(sizes) - 1).bit_length())
        self.count = len(sizes)
        self.sizes, self.tokens = self._summed(sizes), self._summed(tokens)

    def _summed(self, values: np.ndarray) -> np.ndarray:
        levels = [np.zeros(self.leaves, np.int64)]
        levels[0][: len(values)] = values
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).sum(1))
        return np.concatenate([[0], *levels[::-1]])

    def at(self, place: int) -> tuple[int, int]:
        """The segment that holds a place in the text, and where it starts.

        The end of the text belongs to the last segment that is not empty.
        """
        sizes, node, start = self.sizes, 1, 0
        place = min(place, int(sizes[1]) - 1)
        while node < self.leaves:
            node *= 2
            if place - start >= sizes[node]:
                start += int(sizes[node])
                node += 1
        return node - self.leaves, start

    def put(self, segment: int, size: int, tokens: int) -> None:
        node = segment + self.leaves
        more_size, more_tokens = size - self.sizes[node], tokens - self.tokens[node]
        while node:
            self.sizes[node] += more_size
            self.tokens[node] += more_tokens
            node //= 2


class CountedText:
    """A text with its tree. ``encoded`` counts the code points that edits encoded anew."""

    def __init__(self, text: str, sizes: np.ndarray, tokens: np.ndarray, path: str) -> None:
        self.text, self.path, self.encoded = text, path, 0
        self.tree = SegmentTree(sizes, tokens)

    @property
    def n_tokens(self) -> int:
        return int(self.tree.tokens[1])

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replaces code points from ``start`` to ``end``, as the text is now."""
        tree, text = self.tree, self.text
        start = min(max(start, 0), len(text))
        end = min(max(end, start), len(text))
        grown = len(replacement) - (end - start)
        self.text = text[:start] + replacement + text[end:]
        if not text or not self.text:
            self._rebuild()
            return
        # tokens that end LOOKAHEAD before the edit do not depend on it
        first, begin = tree.at(max(0, start - LOOKAHEAD))
        reach = CONTEXT
        while True:
            stop = min(len(self.text), end + grown + reach)
            window = self.text[begin:stop]
            starts, _ = pretoken_starts([window])
            # the first token start after the edit that starts a segment too; what
            # comes after such a place is as before. Near the window's end a start
            # is known only if the text ends there.
            joined = self._first_known(starts, first, begin, end + grown, grown, stop)
            if joined is not None:
                break
            reach *= 4
        stop_segment, stop = joined
        window = self.text[begin:stop]
        pieces = cut(window, starts[: np.searchsorted(starts, len(window))])
        tokens = sum(map(len, vocabulary(self.path).pieces(pieces)))
        self.encoded += len(window)
        for segment in self._between(first + 1, stop_segment):
            tree.put(segment, 0, 0)
        tree.put(first, len(window), tokens)

    def _first_known(
        self, starts: np.ndarray, first: int, begin: int, edited: int, grown: int, stop: int
    ) -> tuple[int, int] | None:
        """The segment and place where the window's tokens meet the old ones again."""
        whole = stop == len(self.text)
        for place in (begin + starts[np.searchsorted(starts, edited - begin) :]).tolist():
            if not whole and place + LOOKAHEAD > stop:
                break
            segment, at = self.tree.at(place - grown)
            if at == place - grown and segment > first and place < len(self.text):
                return segment, place
        return (self.tree.count, stop) if whole else None

    def _between(self, first: int, stop: int) -> list[int]:
        """Segments from first to stop that are not empty."""
        leaves = self.tree.leaves
        return (first + np.flatnonzero(self.tree.sizes[first + leaves : stop + leaves])).tolist()

    def _rebuild(self) -> None:
        pieces, _ = slice_pieces([self.text])
        merged = vocabulary(self.path).pieces(pieces)
        self.encoded += len(self.text)
        self.tree = SegmentTree(np.array([len(p) for p in pieces]), np.array([len(m) for m in merged]))


def _segments(texts: list[str], path: str) -> list[pa.Array]:
    pieces, counts = slice_pieces(texts)
    merged = vocabulary(path).pieces(pieces)
    ends = np.cumsum(counts)
    columns = [np.fromiter(map(len, x), np.int32, len(x)) for x in (pieces, merged)]
    return [lists(c, ends, pa.int32()) for c in columns]


def count_trees(docs: DataFrame, path: str, columns: list[str], text: str = "text") -> DataFrame:
    """``columns``, and ``sizes`` and ``tokens`` of the segments of every text, the
    leaves of its tree. A null text is an empty one, whose tree has no leaves."""
    ints = T.ArrayType(T.IntegerType())
    added = [("sizes", ints), ("tokens", ints)]
    return map_texts(docs, columns, text, added, lambda texts: _segments(texts, path), CHUNK_BYTES)


_COUNTS = [
    ("text", T.StringType()),
    ("sizes", T.ArrayType(T.IntegerType())),
    ("tokens", T.ArrayType(T.IntegerType())),
    ("n_before", T.LongType()),
    ("n_tokens", T.LongType()),
    ("n_encoded", T.LongType()),
]


def _edited(body: str, sizes: np.ndarray, tokens: np.ndarray, todo: list | None, path: str) -> tuple:
    """A row of ``_COUNTS``."""
    before = int(tokens.sum())
    todo = [e for e in todo or [] if e and e["start"] is not None and e["end"] is not None]
    if not todo:
        return body, sizes, tokens, before, before, 0
    counted = CountedText(body, sizes, tokens, path)
    for e in todo:
        counted.edit(e["start"], e["end"], e["replacement"] or "")
    tree = counted.tree
    kept = slice(tree.leaves, tree.leaves + tree.count)
    full = tree.sizes[kept] > 0
    leaves = tree.sizes[kept][full], tree.tokens[kept][full]
    return counted.text, *leaves, before, counted.n_tokens, counted.encoded


def _map_edits(rows: DataFrame, columns: list[str], path: str, made: list[str], chunk: int) -> DataFrame:
    """The ``made`` of ``_COUNTS`` for rows of columns, text, edits and, where it is
    stored, the tree; otherwise the tree is built from the text first."""
    n = len(columns)
    stored = len(rows.columns) > n + 2
    added = [(i, T.StructField(*c)) for i, c in enumerate(_COUNTS) if c[0] in made]
    schema = T.StructType([rows.schema[c] for c in columns] + [f for _, f in added])
    kinds = [pa.string(), *[pa.list_(pa.int32())] * 2, *[pa.int64()] * 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column(n)).to_numpy(), chunk):
                part = batch.slice(a, b - a)
                texts = part.column(n).to_pylist()
                trees = [part.column(n + 2), part.column(n + 3)] if stored else _segments(texts, path)
                leaves = ([x.values.to_numpy() for x in column] for column in trees)
                todo = part.column(n + 1).to_pylist()
                done = list(zip(*(_edited(*x, path) for x in zip(texts, *leaves, todo))))
                kept = [part.column(i) for i in range(n)]
                new = [pa.array(list(done[i]), kinds[i]) for i, _ in added]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def apply_edits(
    trees: DataFrame, path: str, columns: list[str], text: str = "text", edits: str = "edits"
) -> DataFrame:
    """``columns``, the edited ``text``, its tree, and token counts of every row.

    ``edits`` is an array of (start, end, replacement), applied in order; places are
    code points of the text as the edits before left it, and cut to its length. A
    null replacement deletes, null edits and null places change nothing. ``n_before``
    and ``n_tokens`` are the counts before and after, ``n_encoded`` the code points
    encoded anew. The document of each row is edited in one task, as a text is one
    value; rows are independent.
    """
    body = F.coalesce(F.col(text), F.lit("")).alias("__text")
    rows = trees.select(*columns, body, edits, "sizes", "tokens")
    return _map_edits(rows, columns, path, [n for n, _ in _COUNTS], CHUNK_BYTES)


def edited_counts(
    docs: DataFrame, path: str, columns: list[str], text: str = "text", edits: str = "edits"
) -> DataFrame:
    """As ``apply_edits`` for texts whose trees are not stored, and without returning these:
    a tree is built and edited in the same pass."""
    rows = docs.select(*columns, F.coalesce(F.col(text), F.lit("")).alias("__text"), edits)
    made = [n for n, _ in _COUNTS if n not in ("sizes", "tokens")]
    return _map_edits(rows, columns, path, made, CHUNK_BYTES)
