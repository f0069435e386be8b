"""From raw documents to token ids, in five stages that each read what the last one wrote.

Quality rules drop bad documents; repeated runs of lines lose their later copies; of near
duplicates one document stays; documents that hold a benchmark item go; the rest is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from linkloom.llm.store import Store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.keep_new_lines(docs, min_lines=2, min_words=50)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the text they decode to."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    # Workers keep what they remember while other stages run, so it is little here.
    coded = bpe.encode(docs, vocabulary, keep=["doc_id"], cached=100_000)
    return bpe.decode(coded, vocabulary, cached=100_000).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("bpe", tokens),
]

# SQL can express neither the learned rules, SimHash, templates nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again."""
    store = Store(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.put(name, stage(spark, docs, sf_dir))
    return docs
