"""Lexical search, vector codes and neighbours: brute force, odd rows, and the methods themselves."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import entries, lexical, neighbours, vector_codes
from tidemark.session import let_workers_import, new_run_folder

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    let_workers_import(spark)


# -- lexical search -------------------------------------------------------


def ranked(docs, items, k):
    """``docs`` and ``items`` are lists of (id, text)."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(low))
    held = [(i, split(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    count, total = len(held), sum(len(t) for _, t in held)
    out = set()
    for item, text in set(items):
        scores = []
        words = set(split(text))
        weights = {w: math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1)))
                   for w in words if (df := sum(w in t for _, t in held))}
        for n, (doc, tokens) in enumerate(held):
            m = 100 - 50 + (50 * len(tokens) * count) // total
            score = sum(w * ((1_000_000_000 * tokens.count(t)) // (1000 * tokens.count(t) + 20 * m)) for t, w in weights.items())
            if score > 0:
                scores.append((-score, doc is None, doc or 0, n))
        for rank, (score, absent, doc, _) in enumerate(sorted(scores)[:k], 1):
            out.add((item, rank, None if absent else doc, -score))
    return out


def searched(spark, docs, items, k=5, **sizes):
    index = new_run_folder(spark, "index")
    schema = "doc_id long, text string, term string, segment long, docs string"
    rows = spark.createDataFrame([(*d, "clash", None, "clash") for d in docs], schema).repartition(3)
    lexical.build_index(rows, index)
    queries = spark.createDataFrame([(*i, "clash", 1) for i in items], "item_id long, text string, terms string, query int")
    return [tuple(r) for r in lexical.search(spark, index, queries, k=k).collect()]


ODD = [(1, None), (2, ""), (3, "a " * 30_000 + "b"), (3, "a " * 30_000 + "b"), (None, "x Y z"), (5, "x y z"), (6, "X-Y_Z x"),
       (7, "@ +1 1.1.1.1"), (8, "Äpfel äpfel ΑΒ 日本"), (9, "äpfel"), (10, "\x00\x7f \n")]


def test_search_on_odd_rows(spark):
    items = [(1, "x y z q"), (1, "x y z q"), (2, None), (3, ""), (4, "nowhere"), (5, "A b 1"), (None, "äpfel 日本"), (1, "b"), (7, "x " * 9000)]
    got = searched(spark, ODD, items)
    assert set(got) == ranked(ODD, items, 5) and len(got) == len(set(got))
    assert searched(spark, [], items) == searched(spark, ODD, []) == searched(spark, ODD[:2], items) == []


def test_search_equals_brute_force_in_many_segments(spark, monkeypatch):
    dice = random.Random(1)
    words = [f"w{int(dice.paretovariate(0.4)) % 90}" for _ in range(4000)]
    docs = [(i, " ".join(dice.choices(words, k=dice.randrange(1, 40)))) for i in range(500)]
    docs += [(600 + i, docs[7][1]) for i in range(90)]  # ties
    items = [(i, " ".join(dice.choices(words, k=12))) for i in range(12)] + [(99, docs[7][1])]
    assert set(searched(spark, docs, items, k=20)) == ranked(docs, items, 20)


def test_segment_search_skips_and_stays_exact():
    rng = np.random.default_rng(3)
    size = 3000
    lengths = rng.integers(20, 60, size)
    ids = np.stack([rng.permutation(size), np.zeros(size, int)])
    segment = lexical.SegmentSearch(ids, lengths, size, int(lengths.sum()))
    whole, words = np.zeros(size, np.int64), []
    for n, share in enumerate([0.9, 0.7, 0.5, 0.2, 0.01, 0.005, 0.001]):
        held = np.flatnonzero(rng.random(size) < share)
        counts = rng.integers(1, 5, len(held))
        weight = int(1000 * math.log((2 * size + 2) / (2 * len(held) + 1)))
        words.append(b"%d" % n)
        segment.add(words[-1], weight, held, counts)
        whole[held] += lexical.impacts(weight, counts, segment.m[held])
    best = np.lexsort((ids[0], -whole))[:10]
    for floor in (1, int(whole[best[-1]])):
        docs, scores = segment.best(words, 10, floor)
        assert sorted(zip(ids[0][docs], scores)) == sorted(zip(ids[0][best], whole[best]))
        assert segment.scored < size  # most documents are never scored
    assert segment.best([b"none"], 10, 1)[0].size == 0


# -- vector codes ---------------------------------------------------------


def trained(rows, parts, entries_, rounds):
    """Codes, errors and codebooks by definition; ``rows`` are (id, point) in order of id."""
    size = -(-max(map(len, (p for _, p in rows))) // parts)
    points = [[*p, *[0] * (parts * size - len(p))] for _, p in rows]
    cut = [[p[i * size : (i + 1) * size] for i in range(parts)] for p in points]
    book = [[cut[r][i] for r in range(min(entries_, len(rows)))] for i in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda: [[min((far(p[i], c), e) for e, c in enumerate(book[i])) for i in range(parts)] for p in cut]
    for _ in range(rounds):
        codes = near()
        for i in range(parts):
            for e in range(len(book[i])):
                own = [cut[r][i] for r in range(len(cut)) if codes[r][i][1] == e]
                if own:
                    book[i][e] = [sum(x) // len(own) for x in zip(*own)]
    return [([e for _, e in c], sum(d for d, _ in c)) for c in near()], book


def test_codes_on_odd_vectors(spark):
    rng = random.Random(2)
    good = [(i, [rng.uniform(-1, 1) for _ in range(8)], i % 2) for i in range(20)]
    good += [(20, [1.0] * 3, None), (20, [1.0] * 3, None), (21, [], 1), (22, [3e5] * 8, 0), (23, [1e12] + [0.0] * 7, 0), (24, [0.0] * 8, 1)]
    bad = [(30, None, 0), (31, [NAN] * 8, 0), (32, [INF] * 8, 0), (33, [None] * 8, 1)]
    schema = "vec_id long, embedding array<double>, label int, code string, point string"
    rows = spark.createDataFrame([(*r, "clash", "clash") for r in [*good, *bad]], schema)
    coded, book = vector_codes.compress(rows, parts=4, entries=6, rounds=3)
    points = sorted((i, [math.floor(256 * x) for x in v]) for i, v, _ in good)
    want, want_book = trained(points, 4, 6, 3)
    assert book.tolist() == want_book
    got = sorted((r.id, list(bytes(r.code)), r.error) for r in coded.collect())
    assert got == sorted((i, codes, min(error, 2**63 - 1)) for (i, _), (codes, error) in zip(points, want))
    sums = {(r.label, r.label_error) for r in vector_codes.with_label_errors(coded.filter("id < 22")).collect()}
    labels = {None: 0, 0: 0, 1: 0}
    for i, _, label in good:
        if i < 22:
            labels[label] += next(e for j, _, e in got if j == i) if i != 20 else 0
    labels[None] = sum(e for j, _, e in got if j == 20)
    assert sums == set(labels.items())
    restored = {r.id: r.point for r in vector_codes.decoded(coded, book).collect()}
    assert len(restored) == 25 and all(len(p) == 8 for p in restored.values())
    none, empty = vector_codes.compress(rows.limit(0))
    assert none.count() == 0 and empty.size == 0
    assert vector_codes.compress(rows.filter("vec_id = 21"))[0].first().error == 0


def test_bounds_save_distances_and_change_nothing():
    rng = np.random.default_rng(4)
    centres = rng.integers(-400, 400, (48, 4, 3))
    points = centres[rng.integers(0, 48, 600)] + rng.integers(-9, 9, (600, 4, 3))
    column = pa.array(points.reshape(600, -1).tolist(), pa.list_(pa.int64()))
    history, state, saved = [points[:64].transpose(1, 0, 2)], None, 0
    for _ in range(6):
        assigner = vector_codes.Assigner(history)
        rows = vector_codes.matrix(column, 4, 3, assigner.largest)
        whole = assigner.first(rows)
        state = assigner.again(rows, *state[:3]) if state else whole
        assert (state[0] == whole[0]).all()
        # no bound is above the distance it bounds, at the round of its stamp
        for p in range(4):
            apart = rows[:, p, None] - history[-1][p][None]
            far = np.sqrt((apart**2).sum(-1))
            far[np.arange(600), state[0][:, p]] = np.inf
            nearest = far.reshape(600, -1, vector_codes.GROUP).min(-1)
            moved = assigner.moved[state[2][:, p], p, np.arange(nearest.shape[1])]
            assert (state[1][:, p] - moved <= nearest + 1e-6).all()
        saved = 1 - state[3] / whole[3]
        sums = {}
        for p in range(4):
            for e in range(64):
                own = points[state[0][:, p] == e, p]
                if len(own):
                    sums[p, e] = (len(own), own.sum(0).tolist())
        history.append(vector_codes.moved_entries(history[-1], sums))
    assert saved > 0.5


# -- neighbours -----------------------------------------------------------


def recall(rows, found, k):
    """Share of the true neighbours that are found; (id, vector) rows, (query, rank, id, score) found."""
    hit = total = 0
    asked = {}
    for query, rank, near, score in found:
        asked.setdefault(query, []).append((rank, near, score))
    matrix = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    for query, listed in asked.items():
        own = matrix[ids == query][0]
        scores = (matrix * own).sum(1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:k]
        listed.sort()
        assert [r for r, _, _ in listed] == list(range(1, len(order) + 1))
        assert [(-s, i) for _, i, s in listed] == sorted((-s, i) for _, i, s in listed)
        assert all(scores[np.flatnonzero(ids == i)].max() == s for _, i, s in listed)
        hit += len({int(ids[i]) for i in order} & {i for _, i, _ in listed})
        total += len(order)
    return hit / total


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_of_the_registered_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = [tuple(r) for r in entries.op13_neighbours(spark, folder).collect()]
    assert len(found) == 20 * sum(i % 20 == 0 for i, _ in rows)
    assert recall(rows, found, 20) >= 0.95


def test_neighbours_in_many_shards_with_a_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 60)
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((400, 12)) * rng.uniform(0.2, 3, (400, 1))
    vectors[::3] = vectors[0]  # a third of all rows
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = [tuple(r) for r in neighbours.nearest(table, table.filter("vec_id % 20 = 0"), k=10).collect()]
    assert len(found) == 200 and recall(rows, found, 10) >= 0.95
    first = [i for q, _, i, _ in sorted(found) if q == 0]
    twins = [i for i in range(3, 400, 3)]
    tied = set(first) & set(twins)
    assert tied == set(twins[: len(tied)])  # equal scores go by id


def test_neighbours_on_odd_vectors(spark):
    good = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (7, [0.5]), (8, [-1.0, 4.0])]
    bad = [(3, None), (4, [NAN, 1.0]), (5, [INF, 0.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (9, []), (20, [0.0, 0.0])]
    schema = "vec_id long, embedding array<double>, cell string, row string, id string"
    rows = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in [*good, *bad]], schema)
    found = neighbours.nearest(rows, rows.filter("vec_id % 20 = 0"), k=4).orderBy("rank").collect()
    assert [tuple(r) for r in found] == [(0, 1, 2, 2.0), (0, 2, 2, 2.0), (0, 3, 1, 1.0), (0, 4, 7, 0.5)]
    every = neighbours.nearest(rows, rows.filter("vec_id = 0"), k=20).collect()
    assert len(every) == 5
    assert neighbours.nearest(rows.limit(0), rows.limit(0)).count() == 0
    assert neighbours.nearest(rows, rows.limit(0)).count() == neighbours.nearest(rows.limit(0), rows).count() == 0
    twice = neighbours.nearest(rows, rows.filter("vec_id = 2"), k=1).collect()  # a repeated query is asked once
    assert [tuple(r) for r in twice] == [(2, 1, 0, 2.0)]


def test_chi_square_quantiles():
    for dims, quantile in ((2, 5.991464547), (8, 15.50731306), (16, 26.2962276)):
        assert abs(neighbours.chi_square_quantile(0.95, dims) - quantile) < 1e-6
