"""Byte-level BPE encoding and decoding.

Token boundaries are found without a regex. Every code point gets a symbol from
class arrays; each symbol is a function from scanner state to scanner state, and
the state before every code point is the composition of all functions before it.
Composition is associative, so it is computed for whole batches: the functions
generate a small finite set, whose products are looked up in a table.

The slices between boundaries are merged by rank through a bounded cache. Token
ids come with the byte offset of every token, which decoding uses to place bytes
and to decode any range of tokens alone.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.batches import lists, map_texts

# Code point classes. END stands after each text of a batch.
LETTER, NUMBER, OTHER, SPACE, END = range(5)
_END_POINT = 0x110000

# Code points with the property White_Space.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
# What may follow an apostrophe in a token of its own.
SHORT_ENDINGS = ["s", "t", "m", "d"]
LONG_ENDINGS = ["re", "ve", "ll"]

# Scanner states: at the start of a token; in a run of letters, numbers or
# others; after a space that belongs to what follows; one or two letters of an
# apostrophe's ending to come.
FRESH, LETTERS, NUMBERS, OTHERS, JOINED, ONE_LEFT, TWO_LEFT = range(7)
STATES = 7
# Symbols after the first three classes: a space before a word, other white space
# that starts a token or goes on with it, an apostrophe with a short or long
# ending, the end of a text.
S_JOIN, S_START, S_MORE, S_SHORT, S_LONG, S_END = range(3, 9)

_BLOCK = 256
#: Bytes of text whose pre-tokens are held at a time.
CHUNK_BYTES = 1 << 20


@lru_cache(1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter(
        (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(_END_POINT)),
        np.uint8,
        _END_POINT,
    )
    out[WHITE_SPACE] = SPACE
    return np.append(out, np.uint8(END))


@lru_cache(1)
def _rules() -> tuple[np.ndarray, np.ndarray]:
    """By symbol and state: the state after it, and whether a token starts at it."""
    step = np.zeros((9, STATES), np.uint8)
    starts = np.ones((9, STATES), bool)
    for symbol, run in ((LETTER, LETTERS), (NUMBER, NUMBERS), (OTHER, OTHERS)):
        step[symbol] = run
        starts[symbol, [run, JOINED]] = False
    step[LETTER, ONE_LEFT], step[LETTER, TWO_LEFT] = FRESH, ONE_LEFT
    starts[LETTER, [ONE_LEFT, TWO_LEFT]] = False
    for symbol, left in ((S_SHORT, ONE_LEFT), (S_LONG, TWO_LEFT)):
        step[symbol] = left
        step[symbol, [OTHERS, JOINED]] = OTHERS
        starts[symbol, [OTHERS, JOINED]] = False
    step[S_JOIN] = JOINED
    starts[S_MORE] = False
    return step, starts


@lru_cache(1)
def _compositions() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All products of the transition functions: the function of each number, the
    number of each symbol's, the table of products, and token starts."""
    step, starts = _rules()
    numbers = {tuple(range(STATES)): 0}
    work = list(numbers)
    while work:
        f = work.pop()
        for g in step.tolist():
            product = tuple(g[s] for s in f)
            if product not in numbers:
                numbers[product] = len(numbers)
                work.append(product)
    functions = np.array(list(numbers), np.uint8)
    table = [[numbers[tuple(g[s] for s in f)] for g in functions] for f in functions.tolist()]
    of_symbol = np.array([numbers[tuple(g)] for g in step.tolist()], np.intp)
    return functions, of_symbol, np.array(table, np.intp), starts


def _symbols(points: np.ndarray) -> np.ndarray:
    """Symbols of code points that end with the end of a text."""
    symbol = _classes().take(points)
    white = np.flatnonzero(symbol == SPACE)
    before = np.where(white > 0, symbol[white - 1], np.uint8(END))
    word_next = symbol[np.minimum(white + 1, len(symbol) - 1)] < SPACE
    begins = np.where((before != SPACE) | word_next, S_START, S_MORE)
    found = np.where(word_next & (points[white] == 0x20), S_JOIN, begins)
    symbol[symbol == END] = S_END
    symbol[white] = found
    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        padded = np.append(points, [_END_POINT, _END_POINT])
        one, two = padded[quotes + 1], padded[quotes + 2]
        symbol[quotes[np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = S_SHORT
        for a, b in LONG_ENDINGS:
            symbol[quotes[(one == ord(a)) & (two == ord(b))]] = S_LONG
    return symbol


def _scan(symbol: np.ndarray) -> np.ndarray:
    """The state after each symbol: products of the functions up to it, within
    blocks and then over the blocks, applied to the first state."""
    functions, of_symbol, table, _ = _compositions()
    n, size = len(symbol), len(table)
    flat = table.ravel()
    blocks = -(-n // _BLOCK)
    padded = np.zeros(blocks * _BLOCK, np.intp)
    padded[:n] = of_symbol[symbol]
    scan = np.ascontiguousarray(padded.reshape(blocks, _BLOCK).T)
    for i in range(1, _BLOCK):
        scan[i] += scan[i - 1] * size
        scan[i] = flat.take(scan[i])
    total, reach = scan[-1].copy(), 1
    while reach < blocks:
        total[reach:] = flat.take(total[:-reach] * size + total[reach:])
        reach *= 2
    first = np.concatenate(([FRESH], functions[total[:-1], FRESH]))
    scan *= STATES
    scan += first
    return functions.ravel().take(scan).T.ravel()[:n]


def _states_before(symbol: np.ndarray) -> np.ndarray:
    """The state before each symbol.

    All functions but those of apostrophes are constant, unless letters of an ending
    are to come. So only the stretches from the symbol before an apostrophe with an
    ending to the third after it are scanned; each begins with a constant function.
    """
    after = _rules()[0][:, FRESH].take(symbol)
    quotes = np.flatnonzero((symbol == S_SHORT) | (symbol == S_LONG))
    if len(quotes):
        near = np.unique(quotes[:, None] + np.arange(-1, 4))
        near = near[(near >= 0) & (near < len(symbol))]
        after[near] = _scan(symbol[near])
    return np.append(np.uint8(FRESH), after[:-1])


def pretoken_starts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Where pre-tokens start in the texts put together, and how many each text has."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    points = np.insert(points, np.cumsum(sizes), _END_POINT)
    if not len(points):
        return np.zeros(0, np.int64), sizes
    symbol = _symbols(points)
    starts = _compositions()[3].ravel().take(symbol * np.uint8(STATES) + _states_before(symbol))
    starts &= symbol != S_END
    at = np.flatnonzero(starts)
    row = np.searchsorted(np.cumsum(sizes + 1), at, "right")
    return at - row, np.bincount(row, minlength=len(texts))


class _Merged(dict):
    """Ids of pieces met before; emptied when it holds its number of pieces."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.vocab.merge(piece.encode())
        if len(piece) <= self.vocab.CACHED_LENGTH:
            if len(self) >= self.vocab.CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Vocabulary:
    """Ranks of a vocabulary file, and a bounded cache of merged pieces."""

    CACHED_PIECES, CACHED_LENGTH, SHORT = 250_000, 64, 40

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.fromiter(map(len, tokens), np.int64, size)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._cache = _Merged(self)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a piece: the pair of lowest rank is merged first, the left of equals."""
        if piece in self.ranks:
            return (self.ranks[piece],)
        n = len(piece)
        return self._merge_short(piece) if n <= self.SHORT else self._merge_long(piece, n)

    def _merge_short(self, piece: bytes) -> tuple[int, ...]:
        """Looks for the lowest rank anew after each merge."""
        rank_of, none = self.ranks.get, len(self.lengths)
        cuts = list(range(len(piece) + 1))
        pairs = [rank_of(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            lowest = min(pairs)
            if lowest == none:
                break
            i = pairs.index(lowest)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank_of(piece[cuts[i] : cuts[i + 2]], none)
            if i:
                pairs[i - 1] = rank_of(piece[cuts[i - 1] : cuts[i + 1]], none)
        return tuple(self.ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:]))

    def _merge_long(self, piece: bytes, n: int) -> tuple[int, ...]:
        """Keeps the pairs in a heap, so that a long piece takes n log n steps."""
        ranks = self.ranks
        end = list(range(1, n + 1))  # of the part that starts here; 0: no part does
        before = list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(left: int) -> None:
            if left >= 0 and end[left] < n:
                stop = end[end[left]]
                rank = ranks.get(piece[left:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, stop))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, left, stop = heapq.heappop(heap)
            right = end[left]
            if not right or right >= n or end[right] != stop:
                continue
            end[left], end[right] = stop, 0
            if stop < n:
                before[stop] = left
            offer(before[left])
            offer(left)
        return tuple(ranks[piece[i : end[i]]] for i in range(n) if end[i])

    def pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """The ids of each piece."""
        return list(map(self._cache.__getitem__, pieces))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bytes of the tokens, each put at its offset."""
        lengths = self.lengths[ids]
        total = int(lengths.sum())
        source = np.repeat(self.places[ids] - offsets, lengths) + np.arange(total)
        return self.bytes[source]


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: Code points, narrow ones first, of which one that a text lacks marks its cuts.
_MARKS = [*range(0x09), *range(0x0E, 0x20), *range(0x7F, 0xA0), *range(0x10FF00, _END_POINT)]


def cut(text: str, starts: np.ndarray) -> list[str]:
    """The pieces of a text that begin at the given places, the first at 0."""
    if len(starts) < 2:
        return [text] * len(starts)
    mark = next((m for m in map(chr, _MARKS) if m not in text), None)
    if mark is None:
        at = starts.tolist()
        return [text[a:b] for a, b in zip(at, [*at[1:], len(text)])]
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.insert(points, starts[1:], ord(mark)).tobytes().decode("utf-32-le").split(mark)


def slice_pieces(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The pre-tokens of all texts, and how many each has."""
    starts, counts = pretoken_starts(texts)
    return cut("".join(texts), starts), counts


def _encode(texts: list[str], path: str) -> list[pa.Array]:
    vocab = vocabulary(path)
    pieces, counts = slice_pieces(texts)
    merged = vocab.pieces(pieces)
    sizes = np.fromiter(map(len, merged), np.int64, len(merged))
    ids = np.fromiter(chain.from_iterable(merged), np.int32, int(sizes.sum()))
    ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(counts)]
    stops = np.cumsum(vocab.lengths[ids])
    starts = stops - vocab.lengths[ids]
    firsts = np.concatenate(([0], ends[:-1]))
    base = np.append(starts, 0)[firsts]
    offsets = starts - np.repeat(base, ends - firsts)
    return [lists(ids, ends, pa.int32()), lists(offsets.astype(np.int32), ends, pa.int32())]


def encode(docs: DataFrame, path: str, columns: list[str], text: str = "text") -> DataFrame:
    """``columns``, ``ids`` and ``offsets`` (byte where each token starts) of every text.

    A null text is an empty one and has no tokens. Special tokens' strings are
    ordinary text. Repeated rows are encoded like any others; no row moves.
    """
    ints = T.ArrayType(T.IntegerType())
    added = [("ids", ints), ("offsets", ints)]
    return map_texts(docs, columns, text, added, lambda texts: _encode(texts, path), CHUNK_BYTES)


def encode_and_check(docs: DataFrame, path: str, columns: list[str], text: str = "text") -> DataFrame:
    """``columns``, ``ids`` and ``round_trip``: whether the ids decode to the text's bytes.

    Both ways are taken in one pass, so that a task needs one Python worker.
    """
    added = [("ids", T.ArrayType(T.IntegerType())), ("round_trip", T.BooleanType())]

    def work(texts: list[str]) -> list[pa.Array]:
        ids, offsets = _encode(texts, path)
        vocab, checks = vocabulary(path), []
        bounds = ids.offsets.to_numpy().tolist()
        flat, places = ids.values.to_numpy(), offsets.values.to_numpy()
        for body, a, b in zip(texts, bounds, bounds[1:]):
            checks.append(vocab.decode(flat[a:b], places[a:b]).tobytes() == body.encode())
        return [ids, pa.array(checks)]

    return map_texts(docs, columns, text, added, work, CHUNK_BYTES)


def decode(tokens: DataFrame, path: str, columns: list[str]) -> DataFrame:
    """``columns``, ``ids`` and ``decoded``, the bytes of every row's tokens.

    Null ``ids`` decode to no bytes. Ids outside the vocabulary fail the job.
    """
    schema = T.StructType(
        [tokens.schema[c] for c in columns]
        + [tokens.schema["ids"], T.StructField("decoded", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                ids = part.column(len(columns))
                bounds = ids.offsets.to_numpy()
                bounds = bounds - bounds[0]
                flat = ids.flatten().to_numpy(zero_copy_only=False)
                if ids.null_count:
                    lengths = np.where(ids.is_null(), 0, np.diff(bounds))
                    bounds = np.concatenate(([0], np.cumsum(lengths)))
                offsets = part.column(len(columns) + 1).flatten().to_numpy(zero_copy_only=False)
                sizes = vocab.lengths[flat]
                ends = np.concatenate(([0], np.cumsum(sizes)))[bounds]
                base = np.repeat(ends[:-1], np.diff(bounds))
                data = vocab.decode(flat, offsets + base)
                decoded = pa.Array.from_buffers(
                    pa.binary(),
                    len(part),
                    [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)],
                )
                kept = [part.column(i) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays([*kept, ids, decoded], names=schema.fieldNames())

    return tokens.select(*columns, "ids", "offsets").mapInArrow(run, schema)
