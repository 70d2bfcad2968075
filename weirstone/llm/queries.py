"""The operators on their tables, one query each, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.llm import chat_format, decontaminate, language_id, lattice_lm, license_scan, merkle, near_vectors, ngram_join, oracle_sql, packing, quality, spelling, suffix_dedup, token_counts
from weirstone.llm.arrays import bounded_batches
from weirstone.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def fold(divisor: int, remainder: int, key: str = "doc_id") -> Column:
    """Rows whose crc32 of the key as text leaves this remainder; a null key is in no fold."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % divisor == remainder, F.lit(False))


@_query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found, _ = language_id.identify(docs, ~fold(3, 1) & F.col("doc_id").isNotNull())
    return found.select("doc_id", fold(3, 1).alias("held_out"), "language.lang_pred", "language.score", "language.rejected")


@_query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = token_counts.token_counter(public_tokenizers.path("word_bpe_49k.json"))
    text = F.coalesce("text", F.lit(""))
    return (
        read_table(spark, sf_dir, "documents")
        .select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), count(text).alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > 2048)
    )


@_query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        {"<|endoftext|>": 50256},
    )


@_query
def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lattice_lm.score(docs, ~fold(10, 0), public_tokenizers.path("piece_bpe_32k.model"), extra={"held_out": fold(10, 0)})


@_query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@_query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.scan(read_table(spark, sf_dir, "documents"))
    return scanned.withColumn("n_detections", F.size("detections").cast("long")).drop("detections")


@_query
def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@_query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are the sources of ``documents``, their paths the languages within."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    judged = quality.classify(docs, labels, ("quality", "toxic"), F.col("source"), F.col("lang"))
    return judged.withColumn("keep", (F.col("quality_score") >= 0.5) & (F.col("toxic_score") < 0.5))


@_query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"))


@_query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(read_table(spark, sf_dir, "documents"))


@_query
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    tricky = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.format_turns(turns.unionByName(tricky)))


@_query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(read_table(spark, sf_dir, "documents"), fold(7, 0))


@_query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"), spelling.slipped)


ORACLE_SQL |= {
    "op11_chat_format": oracle_sql.CHAT,
    "op12_merkle_manifest": oracle_sql.MERKLE,
    "op13_spelling_variants": oracle_sql.SPELLING,
}
