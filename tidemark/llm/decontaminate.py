"""Benchmark decontamination with an FM-index over every shard of documents.

A shard is a batch of documents as word numbers. Words that no benchmark window
has are replaced by a separator, and runs of other words shorter than the shortest
window are left out, since no window can occur there; the rest is indexed whole.
Windows are searched backward, all at once, by ranks in a wavelet tree of the
Burrows-Wheeler transform. Occurrences are located by stepping to the next sampled
suffix position, and their words merged to spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.llm.batches import bound_batches, slices
from tidemark.session import delete_folder, new_run_folder

WINDOW = 10
#: Text of benchmark items that one pass over the documents searches for. Larger
#: benchmarks take several passes, so that what executors hold stays bounded.
BLOCK_CHARS = 16_000_000
#: Every so many text positions one suffix position is kept.
SAMPLE = 8

# ASCII letters become lower case, what is neither letter, digit nor above ASCII a space.
_FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 32
    for c in range(256)
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class FmIndex:
    """Counts and locates patterns of symbols from 1 in a text of symbols from 0."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        n = len(text) + 1  # with the end, which sorts before all else
        suffixes = _suffix_array(text)
        shifted = np.append(text + 1, 0)
        last = shifted[suffixes - 1]
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(last, minlength=symbols + 2))))
        self.sampled = suffixes % SAMPLE == 0
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = suffixes[self.sampled]
        # Wavelet tree, level by level: each level sorts stably by its bit
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for bit in reversed(range(int(symbols + 1).bit_length())):
            ones = last >> bit & 1
            ranks = np.concatenate(([0], np.cumsum(ones)))
            self.levels.append((bit, ranks, n - int(ranks[-1])))
            last = np.concatenate((last[ones == 0], last[ones == 1]))
        every = np.arange(symbols + 2)
        self.nodes = self._descend(every, np.zeros_like(every))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ranks, zeros in self.levels:
            ones = ranks[at]
            at = np.where(symbol >> bit & 1, zeros + ones, at - ones)
        return at

    def before(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Row of the first suffix that starts with ``symbol`` and goes on as row ``at`` does."""
        return self.starts[symbol] + self._descend(symbol, at) - self.nodes[symbol]

    def search(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Patterns that occur, and their suffix rows from and to."""
        which = np.arange(len(patterns))
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), len(self.sampled), np.int64)
        for step in range(int(sizes.max(initial=0))):
            going = step < sizes[which]
            symbol = patterns[which, np.maximum(sizes[which] - 1 - step, 0)] + 1
            low = np.where(going, self.before(symbol, low), low)
            high = np.where(going, self.before(symbol, high), high)
            found = high > low
            which, low, high = which[found], low[found], high[found]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        out = np.zeros(len(rows), np.int64)
        item = np.arange(len(rows))
        steps = 0
        while len(item):
            done = self.sampled[rows]
            out[item[done]] = self.samples[self.sample_rank[rows[done]]] + steps
            item, rows = item[~done], rows[~done]
            symbol = np.zeros(len(rows), np.int64)
            at = rows
            for bit, ranks, zeros in self.levels:
                one = ranks[at + 1] - ranks[at]
                symbol |= one << bit
                at = np.where(one, zeros + ranks[at], at - ranks[at])
            rows = self.starts[symbol] + at - self.nodes[symbol]
            steps += 1
        return out


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """By doubling: suffixes are ranked by their first 1, 2, 4, ... symbols."""
    n = len(text) + 1
    rank = np.append(text.astype(np.int64) + 1, 0)
    reach = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - reach, 0)] = rank[reach:] + 1
        key = rank * (max(n, int(rank.max()) + 1) + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        reach *= 2


class Windows:
    """The distinct windows of some benchmark items, as numbers of their words."""

    def __init__(self, items: list[tuple[str, str]], size: int = WINDOW) -> None:
        self.words: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        for name, text in items:
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in words_of(text)]
            for i in range(max(len(ids) - size, 0) + 1 if ids else 0):
                found.setdefault(tuple(ids[i : i + size]), set()).add(number[name])
        self.sizes = np.array([len(w) for w in found], np.int64)
        self.patterns = np.zeros((len(found), size), np.int64)
        for row, window in enumerate(found):
            self.patterns[row, : len(window)] = window
        self.items = [sorted(x) for x in found.values()]
        self.shortest = int(self.sizes.min(initial=size))


def _kept_positions(numbers: np.ndarray, shortest: int) -> np.ndarray:
    """Positions in runs of benchmark words that can hold a window, each with the
    position after it, which has a separator."""
    known = np.append(numbers > 0, False)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], known.astype(np.int8)))))
    first, stop = edges[::2], edges[1::2]
    long = stop - first >= shortest
    mark = np.zeros(len(numbers) + 2, np.int64)
    mark[first[long]] += 1
    mark[stop[long] + 1] -= 1
    return np.flatnonzero(np.cumsum(mark)[: len(numbers)])


def find_windows(texts: list[str], windows: Windows):
    """For every text its number of words, merged (first, end) word spans and items."""
    number = windows.words.get
    parts, counts = [], []
    for text in texts:
        ids = [number(w, 0) for w in words_of(text)]
        counts.append(len(ids))
        ids.append(0)
        parts.append(np.array(ids, np.int64))
    spans: list[list[int]] = [[] for _ in texts]
    items: list[list[str]] = [[] for _ in texts]
    if not len(windows.sizes) or not parts:
        return counts, spans, items
    numbers = np.concatenate(parts)
    ends = np.cumsum(np.array(counts) + 1)
    kept = _kept_positions(numbers, windows.shortest)
    if not len(kept):
        return counts, spans, items
    index = FmIndex(numbers[kept], len(windows.words))
    which, low, high = index.search(windows.patterns, windows.sizes)
    times = high - low
    window = np.repeat(which, times)
    rows = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times - low, times)
    at = index.locate(rows)
    mark = np.zeros(len(kept) + 1, np.int64)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + windows.sizes[window], -1)
    hit = np.zeros(len(numbers) + 1, np.int8)
    hit[kept[np.cumsum(mark)[:-1] > 0]] = 1
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit))))
    row = np.searchsorted(ends, edges[::2], "right")
    base = (ends - np.array(counts) - 1)[row]
    for r, a, b in zip(row.tolist(), (edges[::2] - base).tolist(), (edges[1::2] - base).tolist()):
        spans[r] += [a, b]
    row = np.searchsorted(ends, kept[at], "right")
    pairs = np.unique(row * len(windows.sizes) + window)
    for pair in pairs.tolist():
        items[pair // len(windows.sizes)] += windows.items[pair % len(windows.sizes)]
    names = windows.names
    return counts, spans, [sorted({names[i] for i in set(x)}) for x in items]


def _merged(spans: list[int]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _pass_over(
    rows: DataFrame, carried: int, handed: Broadcast[Windows], chunk_bytes: int, cutting: bool = False
) -> DataFrame:
    """One pass: finds the windows and adds to the spans and items of each row.

    If ``cutting``, the text is returned without the spans.
    """
    names = rows.columns
    bound_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column(carried)).to_numpy()
            for a, b in slices(sizes, chunk_bytes):
                part = batch.slice(a, b - a)
                texts = part.column(carried).to_pylist()
                counts, spans, items = find_windows(texts, handed.value)
                old_spans = part.column(carried + 2).to_pylist()
                old_items = part.column(carried + 3).to_pylist()
                spans = [_merged(x + y) if x else y for x, y in zip(old_spans, spans)]
                items = [sorted({*x, *y}) if x else y for x, y in zip(old_items, items)]
                body = part.column(carried)
                if cutting:
                    body = pa.array([cut_words(t, x) for t, x in zip(texts, spans)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(carried)),
                        body,
                        pa.array(counts, pa.int64()),
                        pa.array(spans, pa.list_(pa.int32())),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=names,
                )

    return rows.mapInArrow(run, rows.schema)


def benchmark_blocks(
    benchmark: DataFrame, item_id: str, text: str, block_chars: int
) -> Iterator[tuple[list[Row], bool]]:
    """The items in blocks of about ``block_chars`` characters, one at a time on the driver,
    and whether it is the last."""
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    total = items.agg(F.sum(F.length("text") + F.length("item") + 16)).first()[0] or 0
    blocks = max(1, -(-int(total) // block_chars))
    for block in range(blocks):
        own = F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block
        yield items.filter(own).distinct().collect(), block == blocks - 1


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    columns: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
    chunk_bytes: int = 8 << 20,
    cutting: bool = False,
) -> DataFrame:
    """``columns``, ``n_words``, ``word_spans`` and ``items`` of every row, and the text.

    ``word_spans`` has the first word and the one after the last of each merged
    span; ``items`` the ids, as sorted strings, of items with an occurring window.
    A null text or item is an empty one, without words or windows; a null item id
    counts as the empty string. Repeated items count once; repeated rows of
    documents each get their result. An empty benchmark hits nothing. The text is
    returned as ``text``, whatever its name was, and without the spans if ``cutting``.

    A benchmark of several blocks takes a pass for each. What a pass found is written to
    the shared folder, and its block is given back before the next is made, so no
    process holds two of them.
    """
    spark = docs.sparkSession
    folder = new_run_folder(spark, "windows")
    before = None
    rows = docs.select(
        *columns,
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("word_spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for number, (block, last) in enumerate(benchmark_blocks(benchmark, item_id, item_text, block_chars)):
        handed = spark.sparkContext.broadcast(Windows([tuple(r) for r in block], size))
        rows = _pass_over(rows, len(columns), handed, chunk_bytes, cutting and last)
        if not last:
            written = f"{folder}/{number}"
            rows.write.parquet(written)
            handed.destroy()
            rows = spark.read.parquet(written)
            if before:
                delete_folder(spark, before)
            before = written
    return rows


def cut_words(text: str, word_spans: list[int]) -> str:
    """The text without its words from and to the given numbers, and what is between them."""
    if not word_spans:
        return text
    places = [m.span() for m in _WORD.finditer(text)]
    out, done = [], 0
    for a, b in zip(word_spans[::2], word_spans[1::2]):
        out.append(text[done : places[a][0]])
        done = places[b - 1][1]
    return "".join([*out, text[done:]])


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without the spans that occur in the benchmark; no row is dropped.

    Only hit texts change, and null texts stay null.
    """
    others = [c for c in docs.columns if c != text]
    names = [f"__{i}" for i in range(len(others))]
    renamed = docs.select(*(F.col(c).alias(n) for c, n in zip(others, names)), F.col(text).alias("__t"))
    was_null = renamed.withColumn("__null", F.col("__t").isNull())
    found = contamination(was_null, benchmark, [*names, "__null"], "__t", cutting=True)
    back = found.select(*names, F.when(~F.col("__null"), F.col("text")).alias("__t"))
    return back.toDF(*others, text).select(*docs.columns)

