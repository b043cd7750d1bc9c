"""Registered queries of the operators in this package, and their SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    decontaminate,
    lexical,
    line_dedup,
    neighbours,
    pii,
    quality,
    simhash,
    token_counts,
    topk,
    url_rules,
    vector_codes,
    warc,
)
from tidemark.session import let_workers_import, new_run_folder

RANKS = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda c: c["base"])
    kinds = F.lit(pii.KINDS)

    def count(kind: int):
        return F.size(F.filter(base, lambda c: c["kind"] == kind)).cast("long")

    def joined(spans):
        named = lambda c: F.concat_ws(":", F.get(kinds, c["kind"]), c["start"], c["end"])
        return F.array_join(F.transform(spans, named), ",")

    return found.select(
        "doc_id",
        *(count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rule_table(spark, url_rules.RULES)
    return url_rules.judge(_table(spark, sf_dir, "pages"), rules, ["page_id"])


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    tokens = bpe.encode(_table(spark, sf_dir, "documents"), path, ["doc_id"])
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bpe.decode(tokens, path, ["doc_id"]).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.filter("vec_id % 50 = 0"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_counts(_table(spark, sf_dir, "documents"))
    digest = F.sha2("text", 256).alias("text_sha256")
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_kept", digest)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after base personal data is masked and the source put before the text."""
    path = public_tokenizers.path(RANKS)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    masked = pii.mask_edits(docs, ["doc_id", "source", "text"])
    head = F.concat(F.lit("["), "source", F.lit("] "))
    first = F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"), head.alias("replacement"))
    todo = F.concat("edits", F.when(F.col("source").isNotNull(), F.array(first)).otherwise(F.array()))
    edited = masked.select("doc_id", "text", todo.alias("edits"))
    counted = edited.withColumn("n_edits", F.size("edits").cast("long"))
    return token_counts.edited_counts(counted, path, ["doc_id", "n_edits"]).select(
        "doc_id",
        "n_edits",
        "n_before",
        "n_tokens",
        "n_encoded",
        F.sha2("text", 256).alias("text_sha256"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_histories(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured_at"
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, benchmark, ["doc_id"])
    ends = F.transform("word_spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    hit = F.aggregate(ends, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("word_spans") > 0).alias("contaminated"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model, ["doc_id"]).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = new_run_folder(spark, "index")
    lexical.build_index(_table(spark, sf_dir, "documents"), index)
    return lexical.search(spark, index, _table(spark, sf_dir, "benchmark")).withColumnRenamed("item", "item_id")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, book = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_errors(coded).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.digest(book)).alias("codebooks_sha256"),
    )


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.filter("vec_id % 20 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_simhash": op2_simhash,
    "op3_url_rules": op3_url_rules,
    "op4_bpe": op4_bpe,
    "op5_topk": op5_topk,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_warc": op8_warc,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_lexical_search": op11_lexical_search,
    "op12_vector_codes": op12_vector_codes,
    "op13_neighbours": op13_neighbours,
}

TOP_K_SQL = """
WITH points AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS point
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_inner_product(q.point::DOUBLE[], c.point::DOUBLE[])::BIGINT AS score
  FROM points q JOIN points c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op3_url_rules": url_rules.SQL,
    "op5_topk": TOP_K_SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op11_lexical_search": lexical.SQL,
    "op12_vector_codes": vector_codes.SQL,
}
