"""Personal data by weak supervision.

Candidate spans come from four base patterns and from looser ones around them.
Labelers of three kinds vote on each candidate: regular expressions and checksums,
gazetteers, and the words before it. Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is, without labels. A logistic
span classifier is then trained on the posteriors. It does not see the votes but the
characters of a span and the words around it. Of the candidates that it accepts, and
that overlap, the likelier stays; they are added to the base spans, which always stay.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import map_texts
from tidemark.session import delete_folder, new_run_folder

EMAIL, IP, CARD, PHONE = range(4)
KINDS = ["email", "ip", "card", "phone"]

# Run starts and possessive runs find what the plain patterns do in one pass.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Looser forms: addresses with their signs spelled out or in brackets, card groups set apart by dots
# or slashes, phone numbers without a plus, and cards and phone numbers that the base
# patterns miss because they run into other digits.
_SPELLED = re.compile(
    r"(?<![A-Za-z0-9])[A-Za-z0-9]{1,64}(?:[._+-][A-Za-z0-9]{1,64}){0,4}"
    r" ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]{1,63}){1,4}",
    re.I,
)
_BRACKETED_IP = re.compile(
    r"(?<![A-Za-z0-9.])[0-9]{1,3}(?: ?(?:\.|\[\.\]|\(\.\)|\[dot\]|\(dot\)) ?[0-9]{1,3}){3}(?![A-Za-z0-9])", re.I
)
_GROUPED_CARD = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ ./-][0-9]{4}){3})(?![0-9])")
_PLAIN_PHONE = re.compile(
    r"(?<![0-9+(])(?:00[1-9][0-9 ().-]{7,18}[0-9]|(?:\+[0-9]{1,3} ?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
    r"|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4})(?![0-9])"
)

# Words before a span that speak for its kind.
CUES = {
    EMAIL: {"email", "e-mail", "mail", "contact", "write", "correo", "courriel"},
    IP: {"ip", "host", "server", "address", "addr", "from", "ping"},
    CARD: {"card", "visa", "mastercard", "amex", "credit", "debit", "pan", "karte", "tarjeta", "carte"},
    PHONE: {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "teléfono"},
}
# Words before a span that speak against personal data.
COUNTER_CUES = {"version", "v", "isbn", "section", "page", "order", "ticket", "rev", "release", "no"}
# Public suffixes and calling codes that are common.
SUFFIXES = {"com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "us", "ca"}
CALLING_CODES = ("1", "33", "34", "39", "44", "49", "7", "81", "86", "91", "52", "55", "61", "31", "41", "43")
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "2")

LABELERS = ["base", "strict", "gazetteer", "cue", "counter", "isolated"]
FOR, AGAINST, ABSTAINS = 1, 0, -1
EM_ROUNDS = 50
#: Hashed features of a kind's spans.
FEATURES = 512
#: Distinct candidates of a vote pattern that the classifier is fitted on, about, out of
#: all; there are at most 64 patterns of a kind. Counts of votes cover every candidate.
SAMPLE_A_PATTERN = 256


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        domain = _DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            done = domain.end()
            yield first, done
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def _ip_parts_fit(span: str) -> bool:
    return all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in span.split("."))


def _card_fits(span: str) -> bool:
    digits = _digits(span)
    return 12 <= len(digits) <= 19 and _luhn(digits)


def _phone_fits(span: str) -> bool:
    return 9 <= len(_digits(span)) <= 15


_FITS: dict[int, Callable[[str], bool]] = {IP: _ip_parts_fit, CARD: _card_fits, PHONE: _phone_fits}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost without overlap for each kind."""
    out = [(a, EMAIL, b) for a, b in _emails(text)]
    for kind, pattern in ((IP, _IP), (CARD, _CARD), (PHONE, _PHONE)):
        if kind == PHONE and "+" not in text:
            continue
        for m in pattern.finditer(text):
            if _FITS[kind](m[0]):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of the looser patterns that touch no base span; they may overlap."""
    found = []
    if "[" in text or "(" in text:
        found += [(m.start(), EMAIL, m.end()) for m in _SPELLED.finditer(text)]
        for m in _BRACKETED_IP.finditer(text):
            if ("[" in m[0] or "(" in m[0]) and all(int(p) <= 255 for p in _NUMBER.findall(m[0])):
                found.append((m.start(), IP, m.end()))
    found += [(m.start(), CARD, m.end()) for m in _GROUPED_CARD.finditer(text)]
    found += [(m.start(), PHONE, m.end()) for m in _PLAIN_PHONE.finditer(text)]
    if not found:
        return []
    taken = sorted((a, b) for a, _, b in base)
    starts = [a for a, _ in taken]
    reach = [0, *accumulate((b for _, b in taken), max)]  # of the base spans before each
    return [(a, kind, b) for a, kind, b in sorted(set(found)) if reach[bisect.bisect_left(starts, b)] <= a]


_NUMBER = re.compile("[0-9]+")


def _words_before(text: str, start: int) -> list[str]:
    return re.findall(r"[\w-]+", text[max(0, start - 40) : start].lower())[-3:]


def votes(text: str, start: int, kind: int, end: int, is_base: bool) -> list[int]:
    """What each labeler says of a candidate."""
    span = text[start:end]
    digits = _digits(span)
    before = _words_before(text, start)
    if kind == EMAIL:
        suffix = re.split(r"\.|\[dot\]|\(dot\)", span.lower())[-1].strip()
        strict = 2 <= len(suffix) <= 24 and suffix.isalpha()
        known = suffix in SUFFIXES
    elif kind == IP:
        parts = _NUMBER.findall(span)
        strict = all(p == "0" or not p.startswith("0") for p in parts)
        known = parts[0] not in ("0", "255")
    elif kind == CARD:
        strict = 13 <= len(digits) <= 19 and _luhn(digits)
        known = digits.startswith(CARD_PREFIXES)
    else:
        national = digits[2:] if digits.startswith("00") else digits
        strict = 10 <= len(national) <= 13  # up to 15 are allowed, but hardly in use
        known = ("+" in span or digits.startswith("00")) and national.startswith(CALLING_CODES)
    edges = text[max(0, start - 1) : start] + text[end : end + 1]
    return [
        FOR if is_base else ABSTAINS,
        FOR if strict else AGAINST,
        FOR if known else ABSTAINS if kind == PHONE else AGAINST,
        FOR if CUES[kind].intersection(before) else ABSTAINS,
        AGAINST if COUNTER_CUES.intersection(before) else ABSTAINS,
        AGAINST if any(c.isalnum() or c in "_/#=" for c in edges) else FOR,
    ]


_SHAPE = str.maketrans(
    {**{chr(c): "a" for c in range(97, 123)}, **{chr(c): "A" for c in range(65, 91)}, **{d: "9" for d in "0123456789"}}
)


def features(text: str, start: int, kind: int, end: int) -> list[int]:
    """Hashed features of a span, ascending: its characters, how they are set, words around it.

    Runs of one class of characters count as three at most. The first has no condition.
    """
    span = text[start:end]
    digits = _digits(span)
    setting = "^" + re.sub(r"(.)\1{3,}", r"\1\1\1", span.translate(_SHAPE), flags=re.S) + "$"
    after = re.findall(r"[\w-]+", text[end : end + 40].lower())[:2]
    names = {f"set {setting[i : i + 3]}" for i in range(len(setting) - 2)}
    names |= {"all", f"digits {min(40, len(digits))}", f"long {min(12, (end - start) // 4)}"}
    names |= {f"first {span[:1]}", f"first {span[:2]}", f"last {span[-3:].lower()}"}
    names |= {f"before {w.translate(_SHAPE) if w.isdigit() else w}" for w in _words_before(text, start)}
    names |= {f"after {w.translate(_SHAPE) if w.isdigit() else w}" for w in after}
    names |= {f"beside {c.translate(_SHAPE)}" for c in (text[max(0, start - 1) : start], text[end : end + 1])}
    if kind == CARD:
        names.add(f"checksum {_luhn(digits)}")
    return sorted({zlib.crc32(n.encode(errors="replace")) % FEATURES for n in names})


_SPAN = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("end", T.LongType()),
        T.StructField("base", T.BooleanType()),
        T.StructField("votes", T.StringType()),
        T.StructField("features", T.ArrayType(T.IntegerType())),
    ]
)
_SPAN_ARROW = pa.list_(
    pa.struct(
        [
            ("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()),
            ("base", pa.bool_()), ("votes", pa.string()), ("features", pa.list_(pa.int32())),
        ]
    )
)
_FOUND = ["start", "kind", "end", "base"]
_MARK = {FOR: "+", AGAINST: "-", ABSTAINS: "0"}
_SAID = {mark: vote for vote, mark in _MARK.items()}


def candidates(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` and ``candidates``: every span that a pattern finds, with its votes."""

    def spans(body: str) -> list[dict]:
        base = base_spans(body)
        marked = [(*s, True) for s in base] + [(*s, False) for s in loose_spans(body, base)]
        return [
            {
                "start": a,
                "kind": kind,
                "end": b,
                "base": is_base,
                "votes": "".join(_MARK[v] for v in votes(body, a, kind, b, is_base)),
                "features": features(body, a, kind, b),
            }
            for a, kind, b, is_base in sorted(marked)
        ]

    def work(texts: list[str]) -> list[pa.Array]:
        return [pa.array([spans(t) for t in texts], _SPAN_ARROW)]

    return map_texts(docs, columns, text, [("candidates", T.ArrayType(_SPAN))], work)


class Reliabilities:
    """How far labelers can be trusted, from counts of (kind, votes) alone.

    ``shares[kind]`` is the estimated share of true candidates; ``says[kind][truth]`` has
    the chance of each vote of each labeler on true and false ones.
    """

    def __init__(self, patterns: list[tuple[int, str, int]]) -> None:
        self.shares: dict[int, float] = {}
        self.says: dict[int, np.ndarray] = {}
        for kind in range(len(KINDS)):
            own = [p for p in patterns if p[0] == kind]
            if own:
                self._fit(kind, self._columns([p[1] for p in own]), np.array([p[2] for p in own], float))

    @staticmethod
    def _columns(marks: list[str]) -> np.ndarray:
        return np.array([[_SAID[c] + 1 for c in m] for m in marks])

    def _fit(self, kind: int, said: np.ndarray, times: np.ndarray) -> None:
        # to start with, the majority of those who do not abstain
        true = np.clip(((said == 2).sum(1) + 0.5) / ((said != 0).sum(1) + 1), 0.05, 0.95)
        for _ in range(EM_ROUNDS):
            self.shares[kind] = float((times @ true + 1) / (times.sum() + 2))
            says = np.ones((2, len(LABELERS), 3))
            for truth, weight in ((1, times * true), (0, times * (1 - true))):
                for vote in range(3):
                    says[truth, :, vote] += weight @ (said == vote)
                # votes for count for true spans, votes against for false ones
                says[truth, :, 2 if truth else 1] += 2
            self.says[kind] = says / says.sum(2, keepdims=True)
            true = self._truth(kind, said)

    def _truth(self, kind: int, said: np.ndarray) -> np.ndarray:
        share, says, labelers = self.shares[kind], self.says[kind], np.arange(len(LABELERS))
        odds = np.log(share / (1 - share)) + (np.log(says[1, labelers, said]) - np.log(says[0, labelers, said])).sum(1)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def truth(self, kind: int, marks: list[str]) -> np.ndarray:
        """The chance that candidates with these votes are personal data."""
        return self._truth(kind, self._columns(marks))


class SpanClassifier:
    """Logistic weights of the hashed features, for each kind of its own."""

    def __init__(self) -> None:
        self.weights = np.zeros((len(KINDS), FEATURES))

    def fit(self, kind: int, rows: list[list[int]], truth: np.ndarray, times: np.ndarray) -> None:
        """Newton steps on the chances of truth, with a ridge of one; ``times`` are weights."""
        x = np.zeros((len(rows), FEATURES))
        for row, ids in enumerate(rows):
            x[row, ids] = 1
        times = times * (len(rows) / times.sum())
        w = np.zeros(FEATURES)
        for _ in range(20):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (times * (truth - p)) - w
            curve = (x * (times * p * (1 - p))[:, None]).T @ x + np.eye(FEATURES)
            step = np.linalg.solve(curve, slope)
            w += np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-6:
                break
        self.weights[kind] = w

    def odds(self, kinds: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log odds of candidates whose features are laid end to end, from ``first`` on each."""
        if not len(first):
            return np.zeros(0)
        sizes = np.diff(np.append(first, len(ids)))
        return np.add.reduceat(self.weights[np.repeat(kinds, sizes), ids], first)


def train(found: DataFrame, folder: str) -> SpanClassifier:
    """The classifier of the candidates of all rows.

    Equal candidates are counted together, so copies of a text are one with a weight.
    What comes to the driver are the counts of kinds and votes and a sample of about
    ``SAMPLE_A_PATTERN`` distinct candidates for each, weighted by what it stands for.
    """
    each = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.votes", "c.features")
    each.groupBy("kind", "votes", "features").agg(F.count("*").alias("times")).write.parquet(folder)
    distinct = found.sparkSession.read.parquet(folder)
    counts = distinct.groupBy("kind", "votes").agg(F.sum("times").alias("n"), F.count("*").alias("rows"))
    patterns = counts.orderBy("kind", "votes").collect()
    known = Reliabilities([(r["kind"], r["votes"], r["n"]) for r in patterns])
    whole = 1 << 30
    drawn = F.pmod(F.xxhash64("votes", "features"), F.lit(whole)) < F.lit(whole * SAMPLE_A_PATTERN) / F.col("rows")
    sample = distinct.join(F.broadcast(counts.drop("n")), ["kind", "votes"]).filter(drawn)
    rows = sorted(tuple(r) for r in sample.select("kind", "votes", "features", "times").collect())
    stands = {(r["kind"], r["votes"]): r["n"] for r in patterns}
    drawn_times: dict[tuple[int, str], int] = {}
    for kind, marks, _, times in rows:
        drawn_times[kind, marks] = drawn_times.get((kind, marks), 0) + times
    model = SpanClassifier()
    for kind in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == kind]
        weights = np.array([t * stands[k, m] / drawn_times[k, m] for k, m, _, t in own], float)
        model.fit(kind, [r[2] for r in own], known.truth(kind, [r[1] for r in own]), weights)
    return model


def without_overlaps(spans: list[tuple[float, int, int]]) -> list[int]:
    """Which of the (log odds, start, end) stay: the likeliest first, the first of equal ones."""
    kept: list[int] = []
    starts: list[int] = []
    for i in sorted(range(len(spans)), key=lambda i: (-spans[i][0], spans[i][1], -spans[i][2])):
        at = bisect.bisect_left(starts, spans[i][1])
        # those that stay do not overlap, so only the neighbours can be touched
        clear_before = at == 0 or spans[kept[at - 1]][2] <= spans[i][1]
        if clear_before and (at == len(kept) or spans[kept[at]][1] >= spans[i][2]):
            starts.insert(at, spans[i][1])
            kept.insert(at, i)
    return kept


def _accepted(found: pa.ListArray, model: SpanClassifier) -> pa.ListArray:
    """The base spans of each row, and of the others those accepted that stay."""
    each = found.flatten()
    sizes = pc.list_value_length(found).to_numpy()
    start, kind, end = (each.field(n).to_numpy() for n in ("start", "kind", "end"))
    base = each.field("base").to_numpy(zero_copy_only=False)
    own = each.field("features")
    length = pc.list_value_length(own).to_numpy()
    odds = model.odds(kind, own.flatten().to_numpy(), np.cumsum(length) - length)
    keep = base.copy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    liked = np.flatnonzero(~base & (odds > 0))
    for part in np.split(liked, np.flatnonzero(np.diff(row[liked])) + 1):
        spans = [(float(odds[i]), int(start[i]), int(end[i])) for i in part]
        keep[part[without_overlaps(spans)]] = True
    offsets = np.concatenate(([0], np.cumsum(np.bincount(row[keep], minlength=len(sizes))))).astype(np.int32)
    fields = [each.field(n).filter(pa.array(keep)) for n in _FOUND]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, _FOUND))


def personal_data(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` and ``spans``, an array of (start, kind, end, base), of every row.

    Places are code points, the end exclusive. Base spans are leftmost and without
    overlap for each kind, but those of different kinds may overlap; added spans
    touch no others. A null text is an empty one and has no spans. Repeated rows
    each count for the model. Without any candidate no model is needed.
    """
    spark = docs.sparkSession
    folder = new_run_folder(spark, "pii")
    names = [f"__{i}" for i in range(len(columns))]
    renamed = docs.select(*(F.col(c).alias(n) for c, n in zip(columns, names)), F.col(text).alias("__t"))
    candidates(renamed, names, "__t").write.parquet(f"{folder}/candidates")
    found = spark.read.parquet(f"{folder}/candidates")
    model = train(found, f"{folder}/distinct")
    delete_folder(spark, f"{folder}/distinct")
    kept = T.ArrayType(T.StructType([f for f in _SPAN.fields if f.name in _FOUND]))
    schema = T.StructType([*(found.schema[n] for n in names), T.StructField("spans", kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, own = batch.columns
            yield pa.RecordBatch.from_arrays([*others, _accepted(own, model)], names=schema.fieldNames())

    spans = found.select(*names, "candidates").mapInArrow(run, schema)
    return spans.select(*(F.col(n).alias(c) for c, n in zip(columns, names)), "spans")


def mask_edits(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` and ``edits`` that put a kind's name for each base span, the last first.

    Of overlapping spans the first is masked.
    """
    edit = T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("replacement", T.StringType()),
        ]
    )
    arrow = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("replacement", pa.string())])
    )

    def edits(body: str) -> list[dict]:
        out: list[dict] = []
        for a, kind, b in base_spans(body):
            if not out or a >= out[-1]["end"]:
                out.append({"start": a, "end": b, "replacement": f"[{KINDS[kind]}]"})
        return out[::-1]

    def work(texts: list[str]) -> list[pa.Array]:
        return [pa.array([edits(t) for t in texts], arrow)]

    return map_texts(docs, columns, text, [("edits", T.ArrayType(edit))], work)
