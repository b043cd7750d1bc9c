"""The operators' inner functions against brute force; no Spark session."""

import base64
import random
import re
from functools import reduce
from operator import xor

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe, decontaminate, pii, quality, simhash, token_counts, topk, warc

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


ALPHABET = [
    "a", "b", " ", "  ", "\n", "\t", "'", "s", "t", "re", "ve", "ll", "m", "d", "1", "٣", "é",
    "!", "?", "\u3000", "漢", "\x1c", "😀", "'s", "'re", "\u0301", "\x00",
]


def some_text(r, most):
    return "".join(r.choice(ALPHABET) for _ in range(r.randrange(0, most)))


def test_ids_are_those_of_the_library(encoding):
    r = random.Random(1)
    texts = [some_text(r, 30) for _ in range(3000)] + ["", "'", " ", "ab" * 5000, "'s" * 500]
    for text, ids in zip(texts, bpe._encode(texts, PATH)[0].to_pylist()):
        assert ids == encoding.encode_ordinary(text), text


def test_long_and_short_merges_agree():
    vocab = bpe.vocabulary(PATH)
    for piece in (b"thstinnt", b"abcabcabc", b"aaaaaaaaa", "é漢é漢".encode()):
        assert vocab._merge_long(piece, len(piece)) == vocab._merge_short(piece)


def test_offsets_place_any_range_of_tokens():
    vocab = bpe.vocabulary(PATH)
    ids, offsets = (x.to_pylist()[1] for x in bpe._encode(["x", "Some wörds here"], PATH))
    raw = "Some wörds here".encode()
    ends = [*offsets[1:], len(raw)]
    assert [raw[a:b] for a, b in zip(offsets, ends)] == [
        vocab.decode(np.array([i]), np.array([0])).tobytes() for i in ids
    ]


def test_edits_keep_the_counts_of_a_full_recount():
    r = random.Random(5)
    vocab = bpe.vocabulary(PATH)
    for _ in range(600):
        text = some_text(r, r.choice([5, 40, 200]))
        counted = token_counts.CountedText(
            text, *(c.values.to_numpy() for c in token_counts._segments([text], PATH)), PATH
        )
        for _ in range(r.randrange(1, 8)):
            a = r.randrange(0, len(text) + 2)
            b, new = a + r.randrange(0, r.choice([1, 3, 90])), some_text(r, 5)
            text = text[:a] + new + text[max(a, b) :]
            counted.edit(a, b, new)
            whole = vocab.pieces(bpe.slice_pieces([text])[0])
            assert counted.text == text and counted.n_tokens == sum(map(len, whole))
            assert int(counted.tree.sizes[1]) == len(text)


def test_an_edit_reads_only_its_surroundings():
    text = "some words and more " * 20_000
    counted = token_counts.CountedText(
        text, *(c.values.to_numpy() for c in token_counts._segments([text], PATH)), PATH
    )
    counted.edit(200_000, 200_004, "other")
    assert counted.encoded < 200


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_links_within_the_radius(radius):
    r = np.random.default_rng(radius)
    prints = []
    for base in r.integers(0, 2**63, 30).tolist():
        for _ in range(8):
            flips = r.integers(0, 64, r.integers(0, 6)).tolist()
            prints.append(base ^ reduce(xor, (1 << f for f in flips), 0))
    prints = np.array(prints, np.uint64)
    n = len(prints)
    bounds = [*sorted(r.choice(np.arange(1, n), 5, replace=False).tolist()), n]
    stops = np.repeat(bounds, np.diff([0, *bounds]))
    parent = list(range(n))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i + 1, stops[i]):
            if (int(prints[i]) ^ int(prints[j])).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    assert simhash.linked(prints, stops, radius).tolist() == [top(i) for i in range(n)]


def test_fingerprint_of_each_bit():
    import xxhash

    for text in ("", "One", "a B c d a b c", "x " * 50 + "\u00a0y"):
        words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash._fingerprints([text], 3)[0].to_numpy().view(np.uint64)[0] == want


def test_windows_against_brute_force():
    r = random.Random(3)

    def words(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t)
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)

    for trial in range(25):
        some = ["The", "of", "a1", "é", "And", "x", "y"][: r.randrange(2, 8)] + ["zz", "qq!"] * (trial % 2)
        make = lambda n: " ".join(r.choice(some) for _ in range(r.randrange(0, n)))  # noqa: B023, E731
        texts, size = [make(60) for _ in range(20)], r.choice([3, 5, 10])
        items = [(str(i), make(16)) for i in range(r.randrange(0, 8))]
        counts, spans, found = decontaminate.find_windows(texts, decontaminate.Windows(items, size))
        for text, count, span, names in zip(texts, counts, spans, found):
            own, hit, want = words(text), set(), set()
            for name, item in items:
                w = words(item)
                for k in range(max(len(w) - size, 0) + 1 if w else 0):
                    window = w[k : k + size]
                    for i in range(len(own) - len(window) + 1):
                        if own[i : i + len(window)] == window:
                            hit |= {*range(i, i + len(window))}
                            want.add(name)
            covered = [i for a, b in zip(span[::2], span[1::2]) for i in range(a, b)]
            assert (count, covered, names) == (len(own), sorted(hit), sorted(want))


def test_cut_words():
    assert decontaminate.cut_words("One, two three. Four", [1, 3]) == "One, . Four"
    assert decontaminate.cut_words("x", []) == "x"


def test_base_spans_are_those_of_the_plain_patterns():
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    ]

    def fits(kind, span):
        digits = re.sub("[^0-9]", "", span)
        if kind == 1:
            return all(int(p) <= 255 for p in span.split("."))
        if kind == 2:
            doubled = "".join(str(int(c) * (1 + i % 2)) for i, c in enumerate(digits[::-1]))
            luhn = sum(int(c) * (1 + i % 2) - 9 * (int(c) * (1 + i % 2) > 9) for i, c in enumerate(digits[::-1]))
            return 12 <= len(digits) <= 19 and luhn % 10 == 0 and bool(doubled)
        return kind == 0 or 9 <= len(digits) <= 15

    r = random.Random(1)
    parts = ["a", "b.c", "@", "@x.y", ".", "1", "23", "255", "256", "000", "4111111111111111", " ",
             "-", "+", "+1", "(", "é", "_", "%", "\n", "٣", "0000000000000000"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(0, 14)))
        want = [
            (m.start(), kind, m.end())
            for kind, p in enumerate(patterns)
            for m in re.finditer(p, text)
            if fits(kind, m[0])
        ]
        assert pii.base_spans(text) == sorted(want), text


def test_votes_separate_without_labels():
    known = pii.Reliabilities([(2, "+++00+", 500), (2, "0++00+", 9), (2, "0--0--", 60)])
    assert [p > 0.5 for p in known.truth(2, ["+++00+", "0++00+", "0--0--"])] == [True, True, False]


def test_the_span_classifier_sees_what_the_votes_do_not():
    texts = [f"call {w} 555-010-{n} now" for w in ("tel", "part") for n in range(2000, 2040)]
    spans = [(t.index("555"), t.index(" now")) for t in texts]
    rows = [pii.features(t, a, pii.PHONE, b) for t, (a, b) in zip(texts, spans)]
    model = pii.SpanClassifier()
    model.fit(pii.PHONE, rows, np.array([0.9] * 40 + [0.1] * 40), np.ones(80))
    ids = np.concatenate([np.array(r) for r in rows])
    first = np.cumsum([0] + [len(r) for r in rows[:-1]])
    odds = model.odds(np.full(80, pii.PHONE), ids, first)
    assert (odds[:40] > 0).all() and (odds[40:] < 0).all()


def test_the_likelier_of_overlapping_candidates_stays():
    text = "ring 00491711234567 today"
    found = pii.loose_spans(text, pii.base_spans(text))
    assert {k for _, k, _ in found} == {pii.CARD, pii.PHONE}
    r = random.Random(7)
    for _ in range(200):
        spans = []
        for _ in range(r.randrange(0, 9)):
            a = r.randrange(0, 20)
            spans.append((r.choice([0.5, 1.5, 2.5]), a, a + r.randrange(1, 8)))
        kept = []
        for i in sorted(range(len(spans)), key=lambda i: (-spans[i][0], spans[i][1], -spans[i][2])):
            if all(spans[i][2] <= spans[j][1] or spans[j][2] <= spans[i][1] for j in kept):
                kept.append(i)
        assert sorted(pii.without_overlaps(spans)) == sorted(kept)


def test_loose_candidates_touch_no_base_span():
    text = "host 10[.]0[.]0[.]7 or 10.0.0.8, mail a (at) b (dot) org, 1[.]2[.]3[.]999, +1 4111111111111111"
    base = pii.base_spans(text)
    loose = pii.loose_spans(text, base)
    assert [text[a:b] for a, k, b in loose if k == pii.IP] == ["10[.]0[.]0[.]7"]
    assert [text[a:b] for a, k, b in loose if k == pii.EMAIL] == ["a (at) b (dot) org"]
    assert not any(a < y and x < b for a, _, b in loose for x, _, y in base)


def test_kd_tree_is_exact():
    r = np.random.default_rng(4)
    points = r.integers(-20, 20, (700, 6))
    points[100:200] = points[0]
    ids = r.permutation(700)
    tree = topk.KdTree(ids, points, leaf=16)
    queries = points[:30]
    got = tree.search(ids[:30], queries, np.full(30, -np.inf), 5)
    for own, query, best in zip(ids[:30], queries, got):
        scored = sorted(((int(p @ query), -int(i)) for p, i in zip(points, ids) if i != own), reverse=True)
        assert best == scored[:5]


def test_loser_tree_merges():
    r = random.Random(2)
    for _ in range(100):
        runs = [
            sorted(
                ((r.randrange(9), 0, 0, 0, 0, r.choice("abc"), r.choice("xy"), str(i), 0, 0)
                 for _ in range(r.randrange(0, 6))),
                key=warc._order,
            )
            for i in range(r.randrange(0, 9))
        ]
        want = sorted((e for x in runs for e in x), key=warc._order)
        assert [warc._order(e) for e in warc.LoserTree([iter(x) for x in runs])] == [
            warc._order(e) for e in want
        ]


def test_sum_of_squares_identity():
    r = np.random.default_rng(0)
    model = quality.FactorisationMachine(0.1, r.normal(size=5), r.normal(size=(5, 3)))
    x = np.array([0.5, 0.0, 2.0, -1.0, 0.0])
    slots = np.flatnonzero(x)
    pairs = sum(
        model.factors[i] @ model.factors[j] * x[i] * x[j] for i in range(5) for j in range(i + 1, 5)
    )
    got = model.raw(slots, x[slots], np.array([len(slots)]))[0]
    assert np.isclose(got, 0.1 + model.linear @ x + pairs)


def test_splits_deal_points_to_near_cells():
    r = np.random.default_rng(5)
    points = r.integers(-50, 50, (4000, 3))
    points[:1500] = points[0]
    splits = topk.Splits(points[::10], 8)
    cells = splits.cell_of(points)
    assert splits.cells > 4 and set(cells) == set(range(splits.cells))
    assert len(set(cells[:1500])) == 1
    assert (splits.cell_of(points[:, :2]) == splits.cell_of(np.pad(points[:, :2], ((0, 0), (0, 1))))).all()
    assert topk.Splits(np.zeros((90, 4), np.int64), 8).cells == 1
    assert topk.Splits(np.zeros((0, 0), np.int64), 1).cell_of(points).tolist() == [0] * 4000


def test_blocks_hold_neighbouring_cells():
    assert topk._blocks([3, 4, 9, 0, 25, 1, 2], 10) == ([0, 0, 1, 1, 2, 5, 5], [1, 1, 1, 1, 3, 1, 1])
