"""Whole registered rows against plain versions written here, on the smallest tables."""

import base64
import hashlib
import re

import duckdb
import pytest
import tiktoken
import xxhash
from tiktoken.load import load_tiktoken_bpe

import corpus_pipeline
from tidemark.llm import decontaminate, entries, line_dedup, quality
from tidemark.session import let_workers_import

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
sha = lambda text: hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    let_workers_import(spark)


@pytest.fixture(scope="module")
def tables(spark, small):
    read = lambda name: [r.asDict() for r in spark.read.parquet(f"{small}/{name}.parquet").collect()]
    return {n: read(n) for n in ("documents", "benchmark", "pages", "labels")}


def rows_of(frame, *columns):
    return {r[columns[0]]: tuple(r[c] for c in columns[1:]) for r in frame.select(*columns).collect()}


# -- personal data --------------------------------------------------------


def luhn(digits):
    double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in double) % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    found = [(m.start(), n, kind, m.end()) for n, (kind, pattern, fits) in enumerate(rules)
             for m in re.finditer(pattern, text) if fits(m[0])]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def test_personal_data(spark, small, tables):
    got = rows_of(entries.op1_pii(spark, small), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    want_any = 0
    for doc in tables["documents"]:
        spans = base_spans(doc["text"] or "")
        counts = tuple(sum(k == kind for k, _, _ in spans) for kind in ("email", "ip", "card", "phone"))
        named = [f"{k}:{a}:{b}" for k, a, b in spans]
        *found, listed = got[doc["doc_id"]]
        assert tuple(found) == (*counts, sha(",".join(named)))
        assert set(named) <= set(listed.split(","))
        want_any += sum(counts)
    assert want_any and len(got) == len(tables["documents"])


# -- SimHash --------------------------------------------------------------


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle.encode(), seed=42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit, n in enumerate(counts) if 2 * n > len(shingles))


def components(prints):
    """Smallest id reachable; ``prints`` maps ids to fingerprints."""
    named = dict(zip(prints, prints))
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if named[b] < named[a] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    named[a], changed = named[b], True
    return named


def test_near_duplicates(spark, small, tables):
    prints = {d["doc_id"]: fingerprint(d["text"]) for d in tables["documents"]}
    named = components(prints)
    got = rows_of(entries.op2_simhash(spark, small), "doc_id", "fingerprint", "component_id")
    assert got == {d: (f"{p:016x}", named[d]) for d, p in prints.items()}
    assert any(d != c for d, c in named.items())


# -- tokens ---------------------------------------------------------------


@pytest.fixture(scope="module")
def encoding():
    ranks = load_tiktoken_bpe(entries.public_tokenizers.path(entries.RANKS))
    return tiktoken.Encoding("plain", pat_str=entries.public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens(spark, small, tables, encoding):
    got = rows_of(entries.op4_bpe(spark, small), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    for doc in tables["documents"]:
        ids = encoding.encode_ordinary(doc["text"] or "")
        assert got[doc["doc_id"]] == (len(ids), sha(",".join(map(str, ids))), sha(doc["text"] or ""))


def test_edited_counts(spark, small, tables, encoding):
    got = rows_of(entries.op7_token_counts(spark, small), "doc_id", "n_before", "n_tokens", "text_sha256")
    for doc in tables["documents"]:
        text = doc["text"] or ""
        before, after, digest = got[doc["doc_id"]]
        assert before == len(encoding.encode_ordinary(text))
        # texts without personal data are only given their source; masks are covered by the kernel's tests
        if not base_spans(text):
            edited = (f"[{doc['source']}] " if doc["source"] is not None else "") + text
            assert (after, digest) == (len(encoding.encode_ordinary(edited)), sha(edited))


# -- pages ----------------------------------------------------------------


def test_captures(spark, small, tables):
    payload = {p["page_id"]: (p["html"] or "").encode() for p in tables["pages"]}
    newest = {}
    for page, body in payload.items():
        newest[body] = max(page, newest.get(body, page))
    got = rows_of(entries.op8_warc(spark, small), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == {
        page: (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
               "response" if newest[body] == page else "revisit", None if newest[body] == page else newest[body])
        for page, body in payload.items()
    }


# -- benchmark ------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hits(text, items):
    """Words, words hit, and items that occur; ``items`` are (id, words)."""
    words = WORD.findall((text or "").translate(LOW))
    hit, found = set(), set()
    places = {}
    for item, own in items:
        size = min(10, len(own))
        if size not in places:
            places[size] = {}
            for i in range(len(words) - size + 1) if size else ():
                places[size].setdefault(tuple(words[i : i + size]), []).append(i)
        for i in range(len(own) - size + 1) if size else ():
            for at in places[size].get(tuple(own[i : i + size]), ()):
                hit.update(range(at, at + size))
                found.add(str(item))
    return words, hit, found


def test_decontamination(spark, small, tables):
    items = [(b["item_id"], WORD.findall((b["text"] or "").translate(LOW))) for b in tables["benchmark"]]
    got = rows_of(entries.op9_decontamination(spark, small), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    for doc in tables["documents"]:
        words, hit, found = hits(doc["text"], items)
        assert got[doc["doc_id"]] == (len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    assert any(r[-1] for r in got.values())


# -- pipeline -------------------------------------------------------------


def test_pipeline(spark, small, tables, encoding):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{small}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality.score(docs, model, ["doc_id"]).collect()}
    left = {d["doc_id"]: d["text"] for d in tables["documents"] if scores[d["doc_id"]] >= quality.THRESHOLD}
    # lines by the operator's SQL, which is checked against other data as well
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(left.items()))
    dropped = con.execute(line_dedup.SQL.split("SELECT o.doc_id")[0] + "SELECT doc_id, pos FROM dropped").fetchall()
    gone = set(dropped)
    for doc, text in left.items():
        if text is not None:
            left[doc] = "\n".join(x for i, x in enumerate(text.split("\n")) if (doc, i) not in gone)
    named = components({d: fingerprint(t) for d, t in left.items()})
    left = {d: t for d, t in left.items() if named[d] == d}
    items = [(b["item_id"], WORD.findall((b["text"] or "").translate(LOW))) for b in tables["benchmark"]]
    cut = 0
    for doc, text in left.items():
        _, hit, _ = hits(text, items)
        spans = [x for i in sorted(hit) for x in (i, i + 1)]
        merged = [x for n, x in enumerate(spans) if spans.count(x) == 1]
        left[doc], cut = decontaminate.cut_words(text or "", merged) if hit else text or "", cut + bool(hit)
    assert gone and cut and len(left) < len(tables["documents"])
    got = {r.doc_id: (list(r["ids"]), r.n_tokens, r.round_trip) for r in corpus_pipeline.run(spark, small).collect()}
    want = {d: encoding.encode_ordinary(t) for d, t in left.items()}
    assert got == {d: (ids, len(ids), True) for d, ids in want.items()}
