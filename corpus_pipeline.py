"""From raw documents to packed training sequences.

Each stage works on what its predecessor kept, written as Parquet and read again. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starnorm.llm import packing as best_fit
from starnorm.llm.jaccard_join import keep_one_of_each_component
from starnorm.llm.quality_rules import keep_good
from starnorm.llm.suffix_dedup import without_repeated_bytes
from starnorm.staging import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the current policy keeps."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies.

    Five-word shingles and a similarity of 0.8 or more.
    """
    return keep_one_of_each_component(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings of 200 that are anywhere else; empty ones go.

    ``n_chars`` follows the text. A character cut in half by a removal goes whole.
    """
    return without_repeated_bytes(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in training sequences."""
    return best_fit.pack(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("best_fit_packing", packed),
]

# Packing places are one choice of many that SQL cannot make; tests compare each stage
# with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
