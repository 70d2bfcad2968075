"""From raw documents to packed training sequences; each stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.llm import decontaminate, language_id, ngram_join, packing, suffix_dedup
from weirstone.llm.arrays import bounded_batches
from weirstone.session import fresh_dir
from weirstone.sources.tables import read_table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier does not reject; it learns from all labelled ones."""
    bounded_batches(spark)
    free = "_" + max(docs.columns, key=len)  # a name that no column has
    judged, _ = language_id.identify(docs, F.col("doc_id").isNotNull(), into=free)
    return judged.where(~F.col(f"{free}.rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    bounded_batches(spark)
    return ngram_join.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that occur several times."""
    bounded_batches(spark)
    return suffix_dedup.without_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    bounded_batches(spark)
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    bounded_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, {"<|endoftext|>": 50256})


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("ngram_join", near_duplicates),
    ("suffix_dedup", repeated_strings),
    ("decontaminate", decontaminated),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None  # no stage but the joins can be written in SQL: they learn, tokenize and pack


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
