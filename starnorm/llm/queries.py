"""The operators applied to the supplied tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starnorm.llm import packing as best_fit
from starnorm.llm import sentencepiece_codec as pieces
from starnorm.llm.decontamination import mark
from starnorm.llm.filter_audit import audit_documents
from starnorm.llm.hamming_topk import top_k
from starnorm.llm.jaccard_join import jaccard_components
from starnorm.llm.lm_scoring import score_documents
from starnorm.llm.quality_rules import ablations, ledger, passes
from starnorm.llm.sharding import shard_documents
from starnorm.llm.substring_dedup import remove_repeated_windows
from starnorm.llm.suffix_dedup import remove_repeated_bytes
from starnorm.llm.token_counts import count_tokens
from starnorm.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = ledger(documents(spark, sf_dir))
    return entries.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(F.col("failed"), "base")).alias("base_failed"),
        passes(F.col("failed")).alias("kept"),
        F.col("failed").alias("failed_bits"),
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy rejects, alone and with others."""
    return ablations(ledger(documents(spark, sf_dir)))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op4_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0).withColumnRenamed("id", "vec_id")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        "ids_crc32",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mark(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where a long cannot hold it; ``deviation_exact`` always can."""
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(
        F.col("id").alias("vec_id"),
        "component",
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
        F.col("deviation").alias("deviation_exact"),
    )


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_rules": op2_quality_rules,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_hamming_topk": op4_hamming_topk,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_sharding": op6_sharding,
    "op7_packing": op7_packing,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_filter_audit": op11_filter_audit,
    "op12_decontamination": op12_decontamination,
    "op13_whitening": op13_whitening,
    "quality_ablations": quality_ablations,
}
