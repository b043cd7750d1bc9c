"""Document quality by a factorisation machine.

Features are the hashed words of a text, weighted by frequency, and structure
statistics of it, each put into a bin. The score is
``w0 + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``: all pairwise
interactions at a cost linear in the features. Weights are fitted on a bounded
sample of labelled documents; every document is scored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import lists, map_texts

#: Labelled documents that a model is fitted on at most. Beyond it, those with the
#: smallest hashes of their ids are taken, so that the sample does not depend on order.
SAMPLE_DOCS = 6_000
FOLDS = 5
WORD_SLOTS = 1 << 14
BINS = 16
RANK = 8
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.05, 1e-4
THRESHOLD = 0.3
_CACHED_WORDS = 100_000

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGITS = b"0123456789"
_SPACES = b" \t\n\r\x0b\x0c"
_CLAUSE = b".,;:'\"()?-"
_OTHER_ASCII = bytes(c for c in range(0x21, 0x7F) if c not in _UPPER + _LOWER + _DIGITS + _CLAUSE)
_STATISTICS = 13


def _share_bin(share: float) -> int:
    """0 for none, then finer bins for small shares."""
    return 0 if share <= 0 else min(BINS - 1, 1 + int(15 * min(share, 1.0) ** 0.5))


def _size_bin(size: float) -> int:
    return min(BINS - 1, int(1.5 * np.log1p(size)))


def _statistics(raw: bytes, words: list[bytes], counts: Counter) -> list[int]:
    size = max(1, len(raw))
    number = max(1, len(words))

    def share(kind: bytes) -> float:
        return (len(raw) - len(raw.translate(None, kind))) / size

    lines = raw.split(b"\n")
    return [
        _share_bin(share(_UPPER)),
        _share_bin(share(_LOWER)),
        _share_bin(share(_DIGITS)),
        _share_bin(share(_SPACES)),
        _share_bin(share(_CLAUSE)),
        _share_bin(share(_OTHER_ASCII)),
        _share_bin(raw.count(b"!") / number),
        _share_bin(len(counts) / number),
        _share_bin(max(counts.values(), default=0) / number),
        _share_bin(1 - len({*lines}) / len(lines)),
        _size_bin(len(words)),
        _size_bin(len(words) / len(lines)),
        _size_bin(2 * len(raw) / number),
    ]


class _Slots(dict):
    """Hash slots of words, kept up to a number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        slot = zlib.crc32(word) % WORD_SLOTS
        self[word] = slot
        return slot


_SLOTS = _Slots()


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and weights of all texts, and the end of each one's part."""
    slots: list[int] = []
    weights: list[np.ndarray] = []
    ends = []
    for text in texts:
        raw = text.encode()
        words = raw.lower().split()
        counts = Counter(words)
        slots += [_SLOTS[w] for w in counts]
        often = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)))
        weights.append(often / max(1.0, float(np.sqrt((often**2).sum()))))
        found = _statistics(raw, words, counts)
        slots += [WORD_SLOTS + BINS * i + b for i, b in enumerate(found)]
        weights.append(np.full(_STATISTICS, _STATISTICS**-0.5))
        ends.append(len(slots))
    joined = np.concatenate(weights) if weights else np.zeros(0)
    return np.array(slots, np.int64), joined, np.array(ends, np.int64)


def features(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns``, ``slots`` and ``weights``: the sparse features of every text."""

    def work(texts: list[str]) -> list[pa.Array]:
        slots, weights, ends = _features(texts)
        return [lists(slots, ends, pa.int32()), lists(weights, ends, pa.float64())]

    added = [("slots", T.ArrayType(T.IntegerType())), ("weights", T.ArrayType(T.DoubleType()))]
    return map_texts(docs, columns, text, added, work)


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, slots: np.ndarray, weights: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The score of each row before the logistic function; every row has features."""
        starts = np.concatenate(([0], ends[:-1]))
        if not len(ends):
            return np.zeros(0)
        line = np.add.reduceat(self.linear[slots] * weights, starts)
        scaled = self.factors[slots] * weights[:, None]
        sums = np.add.reduceat(scaled, starts)
        squares = np.add.reduceat(scaled**2, starts)
        return self.bias + line + 0.5 * (sums**2 - squares).sum(1)

    def scores(self, slots: np.ndarray, weights: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(slots, weights, ends), -30, 30)))


def fit(slots: np.ndarray, weights: np.ndarray, ends: np.ndarray, labels: np.ndarray, seed: int = 0):
    """Weights by AdaGrad on the logistic loss, over shuffled batches of rows.

    Without rows the score is 0.5; with labels of one kind only it is their
    smoothed share.
    """
    random = np.random.default_rng(seed)
    size = WORD_SLOTS + BINS * _STATISTICS
    prior = (labels.sum() + 1) / (len(labels) + 2)
    model = FactorisationMachine(
        float(np.log(prior / (1 - prior))), np.zeros(size), random.normal(0, 0.05, (size, RANK))
    )
    if len(set(labels.tolist())) < 2:
        model.factors[:] = 0
        return model
    seen_linear, seen_factors, seen_bias = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
    starts = np.concatenate(([0], ends[:-1]))
    for _ in range(EPOCHS):
        order = random.permutation(len(labels))
        for a in range(0, len(order), BATCH):
            rows = order[a : a + BATCH]
            sizes = (ends - starts)[rows]
            stops = np.cumsum(sizes)
            at = np.arange(stops[-1]) + np.repeat(starts[rows] - stops + sizes, sizes)
            slot, weight = slots[at], weights[at]
            error = model.scores(slot, weight, stops) - labels[rows]
            scaled = model.factors[slot] * weight[:, None]
            sums = np.add.reduceat(scaled, stops - sizes)
            spread = np.repeat(error / len(rows), sizes)
            down = (spread * weight)[:, None] * (np.repeat(sums, sizes, 0) - scaled)
            used, inverse = np.unique(slot, return_inverse=True)
            linear = np.bincount(inverse, spread * weight) + DECAY * model.linear[used]
            factors = np.stack([np.bincount(inverse, down[:, f]) for f in range(RANK)], 1)
            factors += DECAY * model.factors[used]
            seen_linear[used] += linear**2
            seen_factors[used] += factors**2
            seen_bias += error.mean() ** 2
            model.linear[used] -= 4 * RATE * linear / np.sqrt(seen_linear[used])
            model.factors[used] -= RATE * factors / np.sqrt(seen_factors[used])
            model.bias -= RATE * error.mean() / np.sqrt(seen_bias)
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text divides by the folds (null: empty)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == 0


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_docs: int = SAMPLE_DOCS,
) -> FactorisationMachine:
    """A model from at most ``sample_docs`` labelled documents that are not held out.

    Null ids and labels are left out; of several labels of an id the largest
    counts, and of several texts the smallest.
    """
    known = (
        labels.select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__label"))
        .dropna()
        .filter(~held_out("__id"))
        .groupBy("__id")
        .agg(F.max("__label").alias("__label"))
    )
    # labels of documents that an earlier stage took away would use up the sample
    ids = docs.select(F.col(id_col).alias("__id"))
    known = known.join(ids, "__id", "left_semi")
    sample = known.orderBy(F.xxhash64("__id"), "__id").limit(sample_docs)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"))
    # no more rows than sample_docs, each an id and a label
    joined = texts.join(F.broadcast(sample), "__id")
    rows = (
        features(joined, ["__id", "__label"], "__text")
        .groupBy("__id")
        .agg(F.min(F.struct("slots", "weights", "__label")).alias("x"))
        .select("__id", "x.*")
        .toArrow()
        .sort_by("__id")
    )
    slots = rows["slots"].combine_chunks()
    ends = np.cumsum(np.asarray(pc.list_value_length(slots)), dtype=np.int64)
    return fit(
        slots.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
        rows["weights"].combine_chunks().flatten().to_numpy(zero_copy_only=False),
        ends,
        (rows["__label"].to_numpy() > 0).astype(np.float64),
    )


def score(
    docs: DataFrame, model: FactorisationMachine, columns: list[str], text: str = "text"
) -> DataFrame:
    """``columns`` and the ``score`` of every row, 0 to 1; a null text is an empty one.

    Only the text is an input. What is sent to the executors has a size fixed by
    ``WORD_SLOTS``, ``BINS`` and ``RANK``.
    """
    handed = docs.sparkSession.sparkContext.broadcast(model)

    def work(texts: list[str]) -> list[pa.Array]:
        return [pa.array(handed.value.scores(*_features(texts)))]

    return map_texts(docs, columns, text, [("score", T.DoubleType())], work)


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents scored at the threshold or above, with their columns."""
    names = [f"__{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    at = names[docs.columns.index(text)]
    scored = score(renamed, train(docs, labels, id_col, text), names, at)
    return scored.filter(F.col("score") >= threshold).select(*names).toDF(*docs.columns)
