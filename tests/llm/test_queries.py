"""Registered queries on small tables: against their SQL, brute force and odd rows."""

import hashlib
import re

import pyarrow as pa
import pytest
from compare import connect, mismatch
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from tidemark.llm import (
    bpe,
    decontaminate,
    entries,
    line_dedup,
    pii,
    quality,
    simhash,
    token_counts,
    topk,
    url_rules,
    warc,
)
from tidemark.llm.batches import BATCH_BYTES, bound_batches, map_texts

PATH = entries.public_tokenizers.path(entries.RANKS)
#: Queries with a row for each document.
ROW_EACH = [k for k in sorted(entries.QUERIES) if k.split("_")[0] in ("op1", "op2", "op4", "op6", "op7", "op9", "op10")]
NAMES = ["ids", "__text", "dropped", "doc", "lines", "kept", "exact", "__id", "__lines", "__kept", "__text_hash", "first"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES)


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    from tidemark.session import let_workers_import

    let_workers_import(spark)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing column names."""
    long = "word " * 50_000 + "end"
    texts = [(1, None), (2, ""), (3, long), (3, long), (None, "x y z"), (5, "x y z"), (6, "X Y Z"), (7, "@ +1 1.1.1.1")]
    return spark.createDataFrame([(i, t, None, "s", None, *(f"own {n}" for n in NAMES)) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("key", sorted(entries.ORACLE_SQL))
def test_against_sql(spark, small, key):
    assert mismatch(spark, connect(small), small, entries.QUERIES[key], entries.ORACLE_SQL[key]) is None


@pytest.mark.parametrize("key", ROW_EACH)
def test_a_row_for_each_document(spark, small, key):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = entries.QUERIES[key](spark, small)
    assert sorted(r[0] for r in found.select("doc_id").collect()) == sorted(
        r[0] for r in docs.select("doc_id").collect()
    )


def test_bpe_round_trip(odd, empty):
    tokens = bpe.encode(odd, PATH, ["doc_id"])
    found = [(r.doc_id, bytes(r.decoded).decode()) for r in bpe.decode(tokens, PATH, ["doc_id"]).collect()]
    want = [(r.doc_id, r.text or "") for r in odd.collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert bpe.encode(empty, PATH, ["doc_id"]).count() == 0


def test_near_duplicates_by_brute_force(spark, small, odd, empty):
    rows = entries.op2_simhash(spark, small).collect()
    ids, prints = [r.doc_id for r in rows], [int(r.fingerprint, 16) for r in rows]
    component = dict(zip(ids, ids))
    changed = True
    while changed:
        changed = False
        for i, a in zip(ids, prints):
            for j, b in zip(ids, prints):
                if component[j] < component[i] and (a ^ b).bit_count() <= 3:
                    component[i] = component[j]
                    changed = True
    assert {r.doc_id: r.component_id for r in rows} == component
    got = simhash.near_duplicates(odd).groupBy("doc_id", "component_id").count().collect()
    assert {(r.doc_id, r.component_id, r["count"]) for r in got} == {
        (1, 1, 1), (2, 1, 1), (3, 3, 2), (None, 5, 1), (5, 5, 1), (6, 5, 1), (7, 7, 1),
    }
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.one_of_each_group(odd).select("doc_id").collect()
    assert sorted(str(r[0]) for r in kept) == ["1", "3", "5", "7"]


def test_rows_that_share_an_id_are_judged_each(spark):
    texts = [(1, "the same words as there"), (2, "the same words as there"), (2, "nothing like it at all"),
             (3, "a third text of its own"), (3, "and one more with this id"), (None, "the same words as there")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each_group(docs).collect()]
    assert sorted(kept, key=str) == sorted([texts[0], *texts[2:-1]], key=str)
    lone = spark.createDataFrame([(None, "the same words"), (None, "the same words"), (None, "others")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.one_of_each_group(lone).collect()) == ["others", "the same words"]


def test_large_buckets_are_split(spark):
    prints = spark.range(200).select((F.col("id") * 8).alias("fingerprint"))
    whole = simhash.groups_of(simhash.near_links(prints)).count()
    assert simhash.groups_of(simhash.near_links(prints, bucket=16)).count() == whole == 199


def test_url_rules_on_odd_rows(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.org/es/x?y://z", "x://org", "x://a.org./", "x://aorg/",
            "x://example.org/en/12#f", "x://www.example.com/de/", "x://com/fr/", "x://org/" + "a" * 50_000,
            "x://" + "a." * 50_000 + "example.org/es/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls * 2)], "page_id long, url string, key string")
    rules = url_rules.rule_table(spark, [*url_rules.RULES, ("block", "org", "/"), (None, "net", "/")])
    rows = url_rules.judge(pages, rules, ["page_id"], salts=3).collect()
    got = {r.page_id % len(urls): (r.rule, r.verdict) for r in rows}
    assert len(rows) == 2 * len(urls)
    none = (None, "allow")
    assert [got[i] for i in range(len(urls))] == [
        none, none, none, none, ("example.org/es/", "block"), none, none, none,
        ("example.org/en/1", "block"), ("com/de/", "block"), ("com/fr/", "allow"), ("org/", "block"),
        ("example.org/es/", "block"),
    ]
    assert url_rules.judge(pages.limit(0), rules, ["page_id"]).count() == 0
    assert {r.verdict for r in url_rules.judge(pages, rules.limit(0), ["page_id"]).collect()} == {"allow"}


def test_top_k_on_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [nan, 1.0]),
               (5, [inf, 0.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [0.5]), (8, [])]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = topk.top_k(rows, rows.filter("vec_id = 0"), k=3).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 2, 65536)]
    assert topk.top_k(rows, rows.filter("vec_id = 0"), k=9).count() == 5
    assert topk.top_k(rows.limit(0), rows.limit(0)).count() == 0


def test_top_k_over_many_shards_and_blocks(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(topk, "SHARD_POINTS", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    r = np.random.default_rng(6)
    centres = r.normal(size=(6, 4)) * 3
    vectors = [(centres[i % 6] + r.normal(size=4) / 5).tolist()[: 4 - (i % 11 == 0)] for i in range(500)]
    vectors[100:250] = [vectors[100]] * 150  # a hot vector
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = topk.top_k(rows, rows.filter("vec_id % 5 = 0")).collect()
    points = [np.array([np.floor(256 * x) for x in v] + [0.0] * (4 - len(v))) for v in vectors]
    want = set()
    for q in range(0, 500, 5):
        scored = sorted((-int(points[q] @ points[c]), c) for c in range(500) if c != q)[:5]
        want |= {(q, rank, c, -score) for rank, (score, c) in enumerate(scored, 1)}
    assert len(got) == len(want) and {tuple(x) for x in got} == want


def cleaned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in line_dedup.without_recurring_lines(docs).orderBy("doc_id").collect()]


def test_lines_on_odd_rows(spark, odd, empty):
    rows = line_dedup.without_recurring_lines(odd)
    assert rows.columns == odd.columns
    found = {(r.doc_id, r.text) for r in rows.collect()}
    assert (1, None) in found and (2, "") in found and (None, "x y z") in found and (5, "") in found and (6, "X Y Z") in found
    assert all(r[n] == f"own {n}" for r in rows.collect() for n in NAMES)
    assert line_dedup.without_recurring_lines(empty).count() == 0
    repeated = {r.text for r in rows.filter("doc_id = 3").collect()}
    assert len(repeated) == 1 and len(repeated.pop()) > 200_000  # one document given twice


def test_a_line_in_two_documents_stays_in_the_first(spark):
    passage = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(51))
    texts = [f"one\n{passage}\n{passage}", f"two\n  {passage.replace(' ', '  ')}\nend", "three"]
    assert cleaned(spark, texts) == [texts[0], "two\nend", "three"]


def test_lines_that_say_different_things_stay(spark):
    capitals = [f"The capital city of {a} is called {b} today" for a, b in
                [("France", "Paris"), ("Spain", "Madrid"), ("Italy", "Rome"), ("Norway", "Oslo"), ("Peru", "Lima"), ("Cuba", "Havana")]]
    assert cleaned(spark, capitals) == capitals
    years = [f"In 19{n} the town had {n}000 people" for n in range(10, 14)]  # four documents show no field
    assert cleaned(spark, years) == years
    one_document = ["\n".join(f"row {n} of the long table there is here" for n in range(20))]
    assert cleaned(spark, one_document) == one_document


def test_every_line_that_goes_has_a_mate_that_stays(spark):
    rest = "c d e f g h i"
    heads = ["P x", "P y", "P z", "Q z", "R z"]
    assert cleaned(spark, [f"{h} {rest}" for h in heads]) == [f"{h} {rest}" for h in heads]
    lines = [f"P q {x} {rest}" for x in "uvwxyz"]
    assert cleaned(spark, lines) == [lines[0], *[""] * 5]
    # an entry of its own does not lose its mates to a template
    mixed = [lines[0], lines[1], lines[1], *lines[2:], f"P q u {rest} j"]
    assert cleaned(spark, mixed) == [lines[0], *[""] * 6, mixed[-1]]


def test_fields_against_sql(spark):
    import random

    import duckdb
    import pandas as pd

    dice = random.Random(5)
    names = ["Ann", "Bob", "Cy", "Di", "Ed", "Flo", "Gus", "Hal"]
    kinds = ["Posted in the news section by {n} on day {i} of it", "user {i} logged in", "Read {n} and {m} in the old town of ours today",
             "{n} came in by the north gate at noon today", "page {i} {i} {j}", "the {n}", "a b c d e f g h {n} j k l m n o p q r s t u v w x y z {i}"]
    texts = []
    for i in range(60):
        lines = [dice.choice(kinds).format(n=dice.choice(names), m=dice.choice(names), i=dice.randrange(9), j=i) for _ in range(dice.randrange(5))]
        texts.append(dice.choice(["\n", "\n\n"]).join([*lines, f"own line of {i} " + "word " * dice.randrange(40)]) if i % 17 else None)
    documents = pd.DataFrame({"doc_id": range(60), "text": texts})
    con = duckdb.connect()
    con.register("documents", documents)
    want = {tuple(map(str, r)) for r in con.execute(line_dedup.SQL).fetchall()}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = line_dedup.line_counts(docs).select("id", "n_lines", "n_kept", F.sha2("text", 256)).collect()
    assert {tuple(map(str, r)) for r in got} == want
    goes = sum(int(r[1]) - int(r[2]) for r in want)
    lines = [line for t in texts if t for line in set(t.split("\n")) if line.strip()]
    assert goes > len(lines) - len(set(lines))  # more than equal lines


def test_only_repeats_go_from_the_given_documents(spark):
    """Precision: each line that goes is equal to one that stays, but for numbers or a field shown by five documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    before = {r.doc_id: (r.text or "").split("\n") for r in docs.collect()}
    after = {r.doc_id: (r.text or "").split("\n") for r in line_dedup.without_recurring_lines(docs).collect()}
    plain = lambda line: re.sub("[ \t\x0b-\r]+", " ", line).strip()
    stay = {plain(line) for lines in after.values() for line in lines}
    gone = [plain(line) for d, lines in before.items() for line in lines if plain(line) and plain(line) not in map(plain, after[d])]
    assert gone and all(line in stay for line in gone)


def test_edited_counts(odd, empty):
    edits = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(3).cast("long").alias("end"), F.lit("new ").alias("replacement")))
    docs = odd.withColumn("edits", F.when(F.col("doc_id") > 2, edits))
    rows = token_counts.edited_counts(docs, PATH, ["doc_id"]).collect()
    vocab = bpe.vocabulary(PATH)
    for r in rows:
        assert r.n_tokens == sum(map(len, vocab.pieces(bpe.slice_pieces([r.text])[0])))
    trees = token_counts.count_trees(docs, PATH, ["doc_id", "text", "edits"])
    stored = token_counts.apply_edits(trees, PATH, ["doc_id"]).select("doc_id", "text", "n_tokens", "n_encoded")
    assert sorted(map(str, (tuple(x) for x in stored.collect()))) == sorted(str((r.doc_id, r.text, r.n_tokens, r.n_encoded)) for r in rows)
    assert token_counts.edited_counts(empty.withColumn("edits", edits), PATH, ["doc_id"]).count() == 0


def test_warc_round_trip(spark, small, monkeypatch):
    pages = [(1, "http://a.org/x", "same"), (2, None, "same"), (3, "http://a.org/x", None), (4, "bad\r\nurl é", ""),
             (5, "http://b.org", "o" * 200_000), (5, "http://b.org", "o" * 200_000), (None, "x://c", "same")]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = warc.capture_histories(rows).collect()
    assert {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got} == {
        (1, 4, "revisit", 2), (2, 4, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None),
        (5, 200_000, "response", None), (None, 4, "revisit", 2),
    }
    assert len(got) == 7
    assert warc.capture_histories(rows.limit(0)).count() == 0
    monkeypatch.setattr(warc, "RANGE_CAPTURES", 40)  # several ranges, several archives a task
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4096)
    whole = entries.op8_warc(spark, small).collect()
    import base64

    digest = {r.page_id: base64.b32encode(hashlib.sha1(r.html.encode()).digest()).decode()
              for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    assert {r.page_id: r.payload_digest for r in whole} == digest
    keys = [(r.urlkey, r.captured_at) for r in whole]
    assert keys == sorted(keys)


def test_contamination_on_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, "x Y z"), (1, "x Y z"), (None, None), (10, "Z"), (9, "")], "item_id long, text string")
    for chars in (10, 10**6):  # several passes, and one
        rows = decontaminate.contamination(odd, bench, ["doc_id"], block_chars=chars).collect()
        got = {(r.doc_id, tuple(r.word_spans), tuple(r["items"])) for r in rows}
        assert {g for g in got if g[1]} == {(None, (0, 3), ("1", "10")), (5, (0, 3), ("1", "10")), (6, (0, 3), ("1", "10"))}
        assert len(rows) == 8
    cleaned = decontaminate.without_benchmark(odd, bench)
    assert cleaned.columns == odd.columns
    assert {r.text for r in cleaned.filter("doc_id in (1, 5)").collect()} == {None, ""}
    assert decontaminate.contamination(empty, bench, ["doc_id"]).count() == 0
    assert decontaminate.contamination(odd, bench.limit(0), ["doc_id"]).filter("size(items) > 0").count() == 0


def test_personal_data_on_odd_rows(odd, empty):
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.personal_data(odd, ["doc_id"]).collect()}
    assert got[7] == [(5, pii.IP, 12, True)] and got[1] == got[2] == got[3] == []
    assert pii.personal_data(empty, ["doc_id"]).count() == 0


def test_spans_that_only_the_looser_patterns_find(spark):
    """Card numbers that a longer run of digits hides are told from order numbers by all they show."""
    card, plain = "4111 1111 1111 1111", "9000 1234 5678 9017"
    rows = [(i, f"paid by visa card {card} today") for i in range(40)]
    rows += [(100 + i, f"see order no {plain[:-1]}{i % 6 + 1} in the ledger") for i in range(40)]
    rows += [(200, "paid by visa card 4111/1111/1111/1111 today"), (201, "see order no 9000/1234/5678/9011 in the ledger")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.personal_data(docs, ["doc_id"]).collect()}
    assert got[200] == [(18, pii.CARD, 37, False)] and got[201] == []
    assert all(got[i] == [(18, pii.CARD, 37, True)] for i in range(40))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = entries.op10_quality(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    good = [r.score for r in rows if r.quality]
    bad = [r.score for r in rows if not r.quality]
    better = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert right >= 0.93 * len(rows) and better >= 0.98 * len(good) * len(bad)


def test_scores_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    scores = [r.score for r in quality.score(odd, model, ["doc_id"]).collect()]
    assert len(scores) == 8 and all(0 <= s <= 1 for s in scores)
    untrained = quality.train(odd, labels.limit(0))
    assert quality.score(empty, untrained, ["doc_id"]).count() == 0
    assert quality.accepted(odd, labels.limit(0)).columns == odd.columns


def test_pipeline_stage_by_stage(spark, small, odd, empty):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small).columns == corpus_pipeline.COLUMNS
    lined = corpus_pipeline.line_stage(spark, corpus_pipeline.quality_stage(spark, docs, small), small)
    near = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, lined, small).collect()}
    rows = corpus_pipeline.run(spark, small).collect()
    assert {r.doc_id for r in rows} == near and all(r.round_trip for r in rows)
    kept = [labels[r.doc_id] for r in rows if r.doc_id in labels]
    assert sum(kept) >= 0.9 * len(kept)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, small).count() == 0, name
        stage(spark, odd, small).collect()


def test_native_operators_run_no_python(spark, small):
    for key in ("op3_url_rules", "op6_line_dedup"):
        plan = entries.QUERIES[key](spark, small)._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", plan)


def test_batches_of_texts_are_bounded_unless_the_session_says_otherwise(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        texts = spark.range(40, numPartitions=1).select(F.col("id"), F.repeat(F.lit("x"), 1 << 20).alias("text"))
        seen = map_texts(texts, ["id"], "text", [("n", T.LongType())], lambda t: [pa.array([len(t)] * len(t))], 1 << 40)
        found = [r.n for r in seen.collect()]
        assert len(found) == 40 and max(found) <= BATCH_BYTES // (1 << 20) + 1
        spark.conf.set(key, "1m")
        bound_batches(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)
        if before:
            spark.conf.set(key, before)
