"""Near-duplicate documents by SimHash fingerprints.

Fingerprints within a small bit distance are linked and the connected groups
named. Distinct fingerprints are compared only where they agree on two of five
bit blocks: up to three differing bits leave at least two blocks alike. Within
such a bucket the comparison is bit-sliced: each bit position of 64 fingerprints
is one machine word, carry-save counters add up 64 distances at once, and a word
is abandoned once all its distances exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import map_texts
from tidemark.session import new_run_folder

BITS = 64
SEED = 42
SHINGLE_WORDS = 3
RADIUS = 3
#: Blocks that two linked fingerprints share at least; the rest may hold differing bits.
SHARED_BLOCKS = 2
#: Distinct fingerprints of a bucket that one group compares; larger buckets are split.
BUCKET = 16_384
#: Words of 64 comparisons held in memory at a time.
_ITEMS = 1 << 18
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _fingerprints(texts: list[str], words: int) -> list[pa.Array]:
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    ends = []
    for text in texts:
        parts = text.encode().lower().split()  # ASCII case and white space only
        joined = b" ".join(parts)
        if len(parts) <= words:
            if parts:
                hashes.append(digest(joined, SEED))
        else:
            stops = (np.cumsum([len(p) + 1 for p in parts]) - 1).tolist()
            starts = [0, *(s + 1 for s in stops[: -words])]
            hashes += [digest(joined[a:b], SEED) for a, b in zip(starts, stops[words - 1 :])]
        ends.append(len(hashes))
    all_hashes = np.array(hashes, np.uint64)
    out = np.zeros(len(texts), np.uint64)
    first = 0
    for row, end in enumerate(ends):
        votes = np.zeros(BITS, np.int64)
        for a in range(first, end, 1 << 16):
            part = all_hashes[a : min(a + (1 << 16), end), None].view(np.uint8)
            votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, np.int64)
        bits = np.packbits(votes * 2 > end - first, bitorder="little")
        out[row] = bits.view(np.uint64)[0]
        first = end
    return [pa.array(out.view(np.int64))]


def fingerprints(
    docs: DataFrame, columns: list[str], text: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """``columns`` and the 64-bit ``fingerprint`` of every text, as a signed long.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a bit is set if it
    is in over half the shingle hashes. Null and wordless texts have fingerprint 0.
    """
    added = [("fingerprint", T.LongType())]
    return map_texts(docs, columns, text, added, lambda texts: _fingerprints(texts, words))


def _planes(prints: np.ndarray) -> np.ndarray:
    """Bit b of fingerprint 64 w + j as bit j of word w of plane b."""
    padded = np.zeros(-(-len(prints) // BITS) * BITS, np.uint64)
    padded[: len(prints)] = prints
    planes = [
        np.packbits(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
        for b in range(BITS)
    ]
    return np.stack(planes).view(np.uint64)


def _within(
    planes: np.ndarray, prints: np.ndarray, query: np.ndarray, word: np.ndarray,
    lanes: np.ndarray, radius: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items (query, word) with lanes within the radius, and those lanes.

    The counters start so that they overflow at ``radius + 1`` differing bits;
    an overflow is kept.
    """
    width = radius.bit_length()
    start = (1 << width) - 1 - radius
    counters = [np.full(len(query), _ALL if start >> k & 1 else 0, np.uint64) for k in range(width)]
    over = ~lanes
    for b in range(BITS):
        # XOR with the query's bit, spread over the word
        carry = planes[b][word] ^ (np.uint64(0) - ((prints[query] >> np.uint64(b)) & np.uint64(1)))
        for k in range(width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if b % 4 == 3:
            open_items = over != _ALL
            if not open_items.all():
                query, word, over = query[open_items], word[open_items], over[open_items]
                counters = [c[open_items] for c in counters]
                if not len(query):
                    break
    return query, word, ~over


def _smallest(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a and b: each group has the smallest of its labels."""
    while True:
        low = np.minimum(labels[a], labels[b])
        before = labels.copy()
        np.minimum.at(labels, before[a], low)
        np.minimum.at(labels, before[b], low)
        labels = labels[labels]
        if (labels[a] == labels[b]).all():
            return labels


def linked(prints: np.ndarray, stops: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint, the first of those it is linked to within its bucket.

    Buckets lie one after another; ``stops`` has for each row the end of its bucket.
    """
    labels = np.arange(len(prints))
    planes = _planes(prints)
    rows = np.flatnonzero(stops - labels > 1)
    first, last = (rows + 1) >> 6, (stops[rows] - 1) >> 6
    counts = last - first + 1
    ends = np.cumsum(counts)
    at = 0
    while at < len(rows):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + _ITEMS, "right")))
        query = np.repeat(rows[at:to], counts[at:to])
        begin = np.repeat(ends[at:to] - counts[at:to], counts[at:to])
        word = np.arange(done, int(ends[to - 1])) - begin + np.repeat(first[at:to], counts[at:to])
        lanes = np.full(len(query), _ALL)
        head = word == (query + 1) >> 6
        lanes[head] = _ALL << ((query[head] + 1) & 63).astype(np.uint64)
        end = stops[query] - 1
        tail = word == end >> 6
        lanes[tail] &= _ALL >> (63 - (end[tail] & 63)).astype(np.uint64)
        query, word, hits = _within(planes, prints, query, word, lanes, radius)
        for a in range(0, len(query), 1 << 14):
            part = hits[a : a + (1 << 14), None].view(np.uint8)
            item, lane = np.nonzero(np.unpackbits(part, axis=1, bitorder="little"))
            labels = _smallest(labels, query[a + item], (word[a + item] << 6) + lane)
        at = to
    return labels


def _bucket_links(radius: int):
    """Links of each bucket as a star: every linked fingerprint and its bucket's first one."""

    def star(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        bounds = np.flatnonzero(np.append((keys[1:] != keys[:-1]).any(1), True)) + 1
        stops = np.repeat(bounds, np.diff(np.append(0, bounds)))
        root = linked(prints, stops, radius)
        child = np.flatnonzero(root != np.arange(len(root)))
        signed = prints.view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(signed[child]), pa.array(signed[root[child]])], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.zeros((0, 3), np.int64)
        prints = np.zeros(0, np.uint64)
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            keys = np.concatenate((keys, np.stack(columns[:3], 1)))
            prints = np.concatenate((prints, columns[3].view(np.uint64)))
            if not len(keys):
                continue
            # the last bucket may go on in the next batch
            cut = len(keys) - int((keys[::-1] != keys[-1]).any(1).argmax())
            if (keys == keys[-1]).all():
                cut = 0
            if cut:
                yield star(keys[:cut], prints[:cut])
                keys, prints = keys[cut:], prints[cut:]
        if len(keys):
            yield star(keys, prints)

    return run


def near_links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a``-``b`` that connect all distinct fingerprints within ``radius`` bits.

    Each bucket yields fewer links than it has members. A bucket above ``bucket``
    members is dealt into parts, and each pair of parts is a group of its own.
    """
    blocks = radius + SHARED_BLOCKS
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    pieces = [
        F.shiftrightunsigned("fingerprint", a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        for a, b in zip(edges, edges[1:])
    ]
    keys = []
    for n, (i, j) in enumerate(combinations(range(blocks), SHARED_BLOCKS)):
        shift = edges[j + 1] - edges[j]
        keys.append(F.shiftleft(F.shiftleft(F.lit(n).cast("long"), 26) + pieces[i], shift) + pieces[j])
    rows = distinct.select("fingerprint", F.explode(F.array(*keys)).alias("bucket"))
    large = (
        rows.groupBy("bucket")
        .count()
        .filter(F.col("count") > bucket)
        .select("bucket", F.ceil(F.col("count") / (bucket // 2)).cast("long").alias("parts"))
    )
    own = F.pmod(F.xxhash64("fingerprint"), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    dealt = (
        rows.join(large, "bucket", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
        .select("bucket", "fingerprint", own.alias("own"), other.alias("other"))
        .select(
            "bucket",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "fingerprint",
        )
    )
    group = ["bucket", "low", "high"]
    grouped = dealt.repartition(*group).sortWithinPartitions(*group, "fingerprint")
    return grouped.mapInArrow(_bucket_links(radius), "a long, b long").distinct()


def _size_and_sum(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def groups_of(links: DataFrame) -> DataFrame:
    """Connected groups of links ``a``-``b``: each node ``a`` but the smallest, and that one.

    Nodes are moved to smaller neighbours, from both ends in turn, until every
    group is a star. Each round is written to the shared folder, which cuts the
    lineage; only a count and a checksum come to the driver.
    """
    spark = links.sparkSession
    folder = new_run_folder(spark, "groups")

    def written(edges: DataFrame, name: str) -> DataFrame:
        edges.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(ordered.filter("a > b").distinct(), "links")
    state, turn = _size_and_sum(edges), 0
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        outer = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        outer = outer.filter("a > b").distinct()
        least = outer.groupBy("a").agg(F.min("b").alias("low"))
        inner = outer.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
                    F.struct(F.col("a"), F.col("low").alias("b")),
                )
            ).alias("e")
        )
        edges = written(inner.select("e.*").filter("a > b").distinct(), f"round-{turn}")
        before, state, turn = state, _size_and_sum(edges), turn + 1
        if state == before:
            break
    return edges


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """``id_col``, ``fingerprint`` (long) and ``component_id`` of every row.

    A component holds the documents that links of ``radius`` or fewer differing
    bits connect; its id is the smallest document id in it. Equal fingerprints are
    linked, so null and empty texts form one component. Rows without an id get the
    component of the others; it is null if none has an id. Repeated rows stay.
    """
    own = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"))
    found = _components(own, ["__id"], words, radius)
    return found.select(F.col("__id").alias(id_col), "fingerprint", "component_id")


def _components(docs: DataFrame, columns: list[str], words: int, radius: int) -> DataFrame:
    """``columns``, ``fingerprint``, ``root`` (a fingerprint that names the component) and ``component_id``."""
    spark = docs.sparkSession
    folder = new_run_folder(spark, "simhash")
    fingerprints(docs, columns, "__text", words).write.parquet(folder)
    prints = spark.read.parquet(folder)
    distinct = prints.groupBy("fingerprint").agg(F.min("__id").alias("first"))
    stars = groups_of(near_links(distinct.select("fingerprint"), radius))
    root = F.coalesce("b", "fingerprint").alias("root")
    labelled = distinct.join(stars, F.col("fingerprint") == F.col("a"), "left").select(
        "fingerprint", "first", root
    )
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    component = labelled.join(smallest, "root").select("fingerprint", "root", "component_id")
    return prints.join(component, "fingerprint").select(*columns, "fingerprint", "root", "component_id")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that of the smallest id and of these of the smallest hash of its text.

    It is decided by (id, text), so texts that share an id are judged each on its own.
    Rows without an id come after all others of their component.
    """
    spark, names = docs.sparkSession, [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    own, body = (F.col(names[docs.columns.index(c)]) for c in (id_col, text))
    hashed = plain.withColumns({"__id": own, "__text_hash": F.xxhash64(F.coalesce(body, F.lit("")))})
    folder, row = new_run_folder(spark, "rows"), ["__id", "__text_hash"]
    _components(hashed.select(*row, body.alias("__text")), row, SHINGLE_WORDS, RADIUS).write.parquet(folder)
    found = spark.read.parquet(folder).select("root", F.struct(F.isnull("__id").alias("absent"), *row).alias("row"))
    first = found.groupBy("root").agg(F.min("row").alias("first"))
    others = found.join(first, "root").filter(~F.col("row").eqNullSafe(F.col("first"))).select("row.*").distinct()
    gone = others.select(F.col("__id").alias("gone_id"), F.col("__text_hash").alias("gone_hash"))
    same = F.col("__id").eqNullSafe(F.col("gone_id")) & (F.col("__text_hash") == F.col("gone_hash"))
    kept = hashed.join(gone, same, "left_anti").dropDuplicates(row)
    return kept.select(*names).toDF(*docs.columns)
