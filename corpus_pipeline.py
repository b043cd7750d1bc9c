"""Documents to training tokens: quality, line dedup, near-dedup, decontamination, BPE.

Every stage takes ``(spark, docs, sf_dir)``. Its result is written as Parquet and
read again as the next one's documents; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, line_dedup, quality, simhash
from tidemark.session import let_workers_import, new_run_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RANKS = "byte_bpe_multi_50k.tiktoken"


def _counted(docs: DataFrame) -> DataFrame:
    """Documents whose texts may have changed, with the lengths they have now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs.select(*COLUMNS), labels)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that recur across documents go from all but the first."""
    return _counted(line_dedup.without_recurring_lines(docs.select(*COLUMNS)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id."""
    return simhash.one_of_each_group(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of words that occur in the benchmark go; every document stays."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _counted(decontaminate.without_benchmark(docs.select(*COLUMNS), benchmark))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with a check that they decode to the text (null: empty)."""
    path = public_tokenizers.path(RANKS)
    tokens = bpe.encode_and_check(docs, path, ["doc_id", "lang", "source"])
    counted = F.size("ids").cast("long").alias("n_tokens")
    return tokens.select("doc_id", "lang", "source", counted, "ids", "round_trip")


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", token_stage),
]

#: A trained classifier and SimHash fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    let_workers_import(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_run_folder(spark, "pipeline")
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
