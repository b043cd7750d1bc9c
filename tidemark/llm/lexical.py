"""Ranked lexical search: term-at-a-time for short lists, document-at-a-time over long ones.

Documents are indexed in segments of bounded size: for each term of a segment the
documents that hold it and how often, and for each document its number of terms. The
index is a table; every term of every document is in it.

A search takes the postings of its terms, segment by segment. Short lists are summed
term at a time into accumulators, which from then on are one more iterator with
bounds of its own, beside those of the long lists. All are walked document at a time,
in windows of document numbers: blocks whose summed bounds stay below the k-th best
score are skipped; documents come from the essential iterators, those that the others
together cannot replace; the others are only probed at documents that can still
reach the k-th best score.

Some segments are searched first. The k-th best scores found there bound the rest.
Scores are exact integers and the k best of all documents are returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import bound_batches
from tidemark.session import new_run_folder

K = 50
#: Terms and documents of a segment; a document is never split.
SEGMENT_TERMS = 1 << 21
SEGMENT_DOCS = 1 << 15
#: Lists of at most this share of a segment's documents are short.
SHORT = 1 / 64
#: Documents of a block with a bound of its own, and blocks walked at once.
BLOCK = 128
WINDOW = 32
#: Queries of a task, and one in how many segments is searched first.
QUERIES = 512
FIRST = 8

# A-Z are lower-cased before; bytes of 0x80 and above are parts of other letters.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return _TERM.findall(text.lower())


# -- index ----------------------------------------------------------------

_POSTINGS = "segment long, term binary, df long, total long, docs binary, counts binary"


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column from an array and the end of each row's part of it."""
    offsets = np.concatenate(([0], ends)).astype(np.int64) * values.itemsize
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(ends), buffers).cast(pa.binary())


class _Segment:
    def __init__(self):
        self.ids, self.lengths, self.tokens, self.total = [], [], [], 0
        self.numbers: dict[bytes, int] = {}

    def add(self, doc_id: int | None, found: list[bytes]) -> None:
        number = self.numbers
        self.ids.append(doc_id)
        self.lengths.append(len(found))
        self.total += len(found)
        self.tokens.append(np.array([number.setdefault(t, len(number)) for t in found], np.int64))

    def full(self) -> bool:
        return self.total >= SEGMENT_TERMS or len(self.ids) >= SEGMENT_DOCS

    def batches(self, segment: int) -> Iterator[pa.RecordBatch]:
        """A row for each term, and one without a term for the documents."""
        documents = len(self.ids)
        keys = np.concatenate(self.tokens) * documents + np.repeat(np.arange(documents), self.lengths)
        keys, counts = np.unique(keys, return_counts=True)
        term, docs = keys // documents, keys % documents
        ends = np.searchsorted(term, np.arange(len(self.numbers)), "right")
        names = _columns(_POSTINGS)
        step = 1 << 16
        words = list(self.numbers)
        for a in range(0, len(words), step):
            b = min(a + step, len(words))
            first = ends[a - 1] if a else 0
            own = ends[a:b] - first
            parts = (x[first : ends[b - 1]].astype(np.uint32) for x in (docs, counts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(b - a, segment)),
                    pa.array(words[a:b], pa.binary()),
                    pa.array(np.diff(np.concatenate(([0], own))), pa.int64()),
                    pa.array(np.add.reduceat(counts[first : ends[b - 1]], np.concatenate(([0], own[:-1]))), pa.int64()),
                    *(_binaries(p, own) for p in parts),
                ],
                names=names,
            )
        # ids stand where the document numbers of a term would, lengths where its counts would
        known = np.array([-1 if i is None else i for i in self.ids], np.int64)
        absent = np.array([i is None for i in self.ids], np.int64)
        lengths = np.stack([np.array(self.lengths, np.int64), absent])
        row = [[segment], [None], [documents], [self.total], [known.tobytes()], [lengths.tobytes()]]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=names)


def _columns(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def build_index(docs: DataFrame, folder: str, id_col: str = "doc_id", text: str = "text") -> None:
    """Write the index of all documents with a term to ``folder``.

    Null texts and texts without terms are in no segment. Repeated rows are documents
    each; ids may be null. Other columns, whatever their names, are not read.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, open_one = None, _Segment()
        for batch in batches:
            for number, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = terms(text)
                if found:
                    # a row's own number names its segment, so no two have the same
                    segment = number if segment is None else segment
                    open_one.add(doc_id, found)
                    if open_one.full():
                        yield from open_one.batches(segment)
                        segment, open_one = None, _Segment()
            pa.default_memory_pool().release_unused()
        if open_one.ids:
            yield from open_one.batches(segment)

    rows = docs.filter(F.col(text).isNotNull()).select(
        F.monotonically_increasing_id(), F.col(id_col).cast("long"), F.col(text).cast("binary")
    )
    rows.mapInArrow(run, _POSTINGS).write.parquet(folder)


# -- search in a segment --------------------------------------------------


class Postings:
    """Documents (ascending) and what each adds to a score, with a bound for every block."""

    def __init__(self, docs: np.ndarray, scores: np.ndarray, blocks: int):
        self.docs, self.scores = docs, scores
        self.largest = int(scores.max(initial=0))
        self.bounds = np.zeros(blocks, np.int64)
        if len(docs):
            block = docs // BLOCK
            starts = np.flatnonzero(np.diff(block, prepend=-1))
            self.bounds[block[starts]] = np.maximum.reduceat(scores, starts)

    def between(self, low: int, high: int) -> slice:
        return slice(*np.searchsorted(self.docs, (low, high)))

    def at(self, wanted: np.ndarray) -> np.ndarray:
        """Scores at documents, zero where there is none."""
        places = np.minimum(np.searchsorted(self.docs, wanted), len(self.docs) - 1)
        return np.where(self.docs[places] == wanted, self.scores[places], 0)


def impacts(weight: int, counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to the scores of documents that hold it ``counts`` times."""
    return weight * ((1_000_000_000 * counts) // (1000 * counts + 20 * m))


class SegmentSearch:
    def __init__(self, ids: np.ndarray, lengths: np.ndarray, documents: int, length: int):
        """``ids``, and whether each is absent, in two rows; N and L of the whole collection."""
        self.ids, self.size = ids, ids.shape[1]
        self.m = 100 - 50 + (50 * lengths * documents) // length
        self.blocks = -(-self.size // BLOCK)
        self.short = max(1, int(self.size * SHORT))
        self.lists: dict[bytes, Postings] = {}
        self.scored = 0

    def add(self, term: bytes, weight: int, docs: np.ndarray, counts: np.ndarray) -> None:
        scores = impacts(weight, counts.astype(np.int64), self.m[docs])
        self.lists[term] = Postings(docs.astype(np.int64), scores, self.blocks)

    def _iterators(self, words: list[bytes]) -> list[Postings]:
        """The accumulators of the short lists, and the long lists."""
        lists = [self.lists[w] for w in words if w in self.lists]
        short = [p for p in lists if len(p.docs) <= self.short]
        long = [p for p in lists if len(p.docs) > self.short]
        if short:
            docs, place = np.unique(np.concatenate([p.docs for p in short]), return_inverse=True)
            sums = np.zeros(len(docs), np.int64)
            np.add.at(sums, place, np.concatenate([p.scores for p in short]))
            long.append(Postings(docs, sums, self.blocks))
        return sorted((p for p in long if p.largest), key=lambda p: p.largest)

    def best(self, words: list[bytes], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the ``k`` best documents that reach ``floor`` (at least 1)."""
        lists = self._iterators(words)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        bounds = sum((p.bounds for p in lists), np.zeros(self.blocks, np.int64))
        reach = np.cumsum([0] + [p.largest for p in lists])  # of the lists before each
        floor = max(1, floor)
        for first in range(0, self.blocks, WINDOW):
            live = bounds[first : first + WINDOW] >= floor
            if not live.any():
                continue
            low, high = first * BLOCK, min((first + WINDOW) * BLOCK, self.size)
            # lists before this one cannot reach the floor together
            essential = int(np.searchsorted(reach, floor, "left")) - 1
            sums = np.zeros(high - low, np.int64)
            for p in lists[essential:]:
                part = p.between(low, high)
                sums[p.docs[part] - low] += p.scores[part]
            sums[np.repeat(~live, BLOCK)[: high - low]] = 0
            at = np.flatnonzero(sums)
            for i in range(essential - 1, -1, -1):
                at = at[sums[at] + reach[i + 1] >= floor]
                sums[at] += lists[i].at(at + low)
            at = at[sums[at] >= floor]
            self.scored += len(at)
            if not len(at):
                continue
            docs, scores = np.concatenate([docs, at + low]), np.concatenate([scores, sums[at]])
            if len(scores) > k:
                kept = self._cut(docs, scores, k)
                docs, scores = docs[kept], scores[kept]
            if len(scores) == k:
                floor = max(floor, int(scores.min()))
        return docs, scores

    def _cut(self, docs: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Highest scores, of equal ones the smaller ids, absent ids last."""
        least = np.partition(scores, -k)[-k]
        near = np.flatnonzero(scores >= least)
        absent, ids = self.ids[1][docs[near]], self.ids[0][docs[near]]
        return near[np.lexsort((ids, absent, -scores[near]))[:k]]


# -- search ---------------------------------------------------------------


def _asked(queries: DataFrame, id_col: str, text: str) -> DataFrame:
    """``query`` (a number), ``item`` and its distinct ``terms``, a row for each distinct query."""
    item = queries.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField("query", T.LongType()), T.StructField("item", item), T.StructField("terms", T.ArrayType(T.BinaryType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch.column(2).to_pylist()]
            made = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(made, names=["query", "item", "terms"])

    rows = queries.filter(F.col(text).isNotNull()).select(F.col(id_col).alias("item"), F.col(text).alias("body")).distinct()
    numbered = rows.select(F.monotonically_increasing_id(), "item", F.col("body").cast("binary"))
    return numbered.mapInArrow(run, schema).filter(F.size("terms") > 0)


_FOUND = "query long, absent long, doc_id long, score long"


def _searched(
    postings: DataFrame, wanted: DataFrame, segments: DataFrame, queries: DataFrame, facts: tuple[int, int], k: int
) -> DataFrame:
    """The ``k`` best of each query (``words`` with weights, ``floor``) in each segment.

    A task holds a segment's documents, the queries of one block, and their postings.
    ``wanted`` has the terms of each block.
    """

    def search(lists: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[list] = [[], [], [], []]
        for row in asked.to_pylist() if lists.num_rows else []:  # one a segment and block
            lengths, absent = np.frombuffer(row["lengths"], np.int64).reshape(2, -1)
            ids = np.stack([np.frombuffer(row["ids"], np.int64), absent])
            segment = SegmentSearch(ids, lengths, *facts)
            weights = {w["term"]: w["weight"] for query in row["queries"] for w in query["words"]}
            for term, docs, counts in zip(*(lists[c].to_pylist() for c in ("term", "docs", "counts"))):
                segment.add(term, weights[term], np.frombuffer(docs, np.uint32), np.frombuffer(counts, np.uint32))
            for query in row["queries"]:
                docs, scores = segment.best([w["term"] for w in query["words"]], k, query["floor"])
                parts = ([query["query"]] * len(docs), ids[1][docs].tolist(), ids[0][docs].tolist(), scores.tolist())
                for column, values in zip(found, parts):
                    column.extend(values)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(_columns(_FOUND), found)})

    lists = postings.join(wanted, "term").select("segment", "block", "term", "docs", "counts")
    # a block of the stated queries, about QUERIES of them, goes to every segment
    packed = queries.groupBy(F.col("block").alias("of")).agg(F.collect_list(F.struct("query", "words", "floor")).alias("queries"))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(queries.agg(F.max("block")).first()[0] or 0)))
    places = segments.select(F.col("segment").alias("in"), blocks.alias("at"), F.col("docs").alias("ids"), F.col("counts").alias("lengths"))
    asked = places.join(packed, F.col("at") == F.col("of")).drop("of")
    return lists.groupBy("segment", "block").cogroup(asked.groupBy("in", "at")).applyInArrow(search, _FOUND)


def search(
    spark: SparkSession,
    index: str,
    queries: DataFrame,
    id_col: str = "item_id",
    text: str = "text",
    k: int = K,
) -> DataFrame:
    """``item``, ``rank`` from 1, ``doc_id`` and ``score``: the ``k`` best documents of each query.

    ``index`` is a folder that ``build_index`` wrote. Only scores above 0 count, equal
    ones go by id, absent ids last; repeated documents have a place each. A query that
    is repeated with the same id is asked once, one id with several texts is asked
    with each. Queries without terms, or of terms that no document has, have no rows.
    """
    folder = new_run_folder(spark, "lexical")

    def kept(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = spark.read.parquet(index)
    postings, segments = rows.filter("term IS NOT NULL"), rows.filter("term IS NULL")
    documents, length = segments.agg(F.sum("df"), F.sum("total")).first()
    asked = kept(_asked(queries, id_col, text), "asked")
    blocks = -(-asked.count() // QUERIES)
    if not documents or not blocks:
        nothing = asked.limit(0).select("item", F.lit(1).alias("rank"))
        return nothing.withColumns({c: F.lit(0).cast("long") for c in ("doc_id", "score")})
    words = asked.select("query", F.explode("terms").alias("term"))
    held = postings.select("term", "df").join(words.select("term").distinct(), "term", "left_semi")
    odds = F.lit(2.0 * documents + 2) / (2 * F.col("held") + 1)
    weights = held.groupBy("term").agg(F.sum("df").alias("held")).select("term", F.floor(1000 * F.log(odds)).alias("weight"))
    weighted = words.join(weights, "term").groupBy("query").agg(F.collect_list(F.struct("term", "weight")).alias("words"))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
    ready = kept(weighted.withColumn("block", block), "queries")
    # a table of its own, so that Spark knows its size and moves it to the postings if it is small
    wanted = kept(ready.select("block", F.explode("words.term").alias("term")).distinct(), "wanted")
    early = F.pmod(F.xxhash64("segment"), F.lit(FIRST)) == 0
    facts = (documents, length)
    first = ready.withColumn("floor", F.lit(1).cast("long"))
    near = kept(_searched(postings.filter(early), wanted, segments.filter(early), first, facts, k), "near")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"))
    kth = near.withColumn("at", F.row_number().over(by_score)).filter(F.col("at") == k)
    floors = ready.join(kth.select("query", F.col("score").alias("floor")), "query", "left").fillna(1, "floor")
    found = near.unionByName(_searched(postings.filter(~early), wanted, segments.filter(~early), floors, facts, k))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "absent", "doc_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = best.join(asked.select("query", "item"), "query")
    doc_id = F.when(F.col("absent") == 0, F.col("doc_id")).alias("doc_id")
    return named.select("item", "rank", doc_id, "score")


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SQL_TERMS = (
    f"regexp_extract_all(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
SQL = f"""
WITH token AS (SELECT doc_id, unnest({_SQL_TERMS}) AS term FROM documents),
item AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark),
doc AS (SELECT doc_id, count(*) AS n FROM token GROUP BY doc_id),
facts AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM doc),
tf AS (SELECT doc_id, term, count(*) AS tf FROM token WHERE term IN (SELECT term FROM item) GROUP BY doc_id, term),
weight AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), facts
), scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM item JOIN tf USING (term) JOIN weight USING (term) JOIN doc USING (doc_id), facts
  GROUP BY item_id, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= {K}
"""
