"""A training-data pipeline over ``documents``: quality rules, near-duplicates, repeated passages, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsfold.llm import packing, prob_minhash, quality, suffix_dedup
from newsfold.llm.queries import WORD_VOCABULARY, tokenizer_path
from newsfold.llm.scratch import Scratch
from newsfold.llm.shipping import ship
from newsfold.session import configured


#: Bytes of a repeated passage here: 50 words of the shortest kind, where the operator's own query takes 400.
PASSAGE_BYTES = 250


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship(configured(spark))
    return quality.filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies."""
    ship(configured(spark))
    return prob_minhash.keep_one_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of ``PASSAGE_BYTES`` that start elsewhere, too; a document may be left empty, but it stays."""
    ship(configured(spark))
    return suffix_dedup.clean_documents(docs, PASSAGE_BYTES)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with the sequence and the offset each is packed to."""
    ship(configured(spark))
    return packing.pack_documents(docs, tokenizer_path(WORD_VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("repeated_passages", repeated_passages),
    ("best_fit_packing", best_fit_packing),
]

#: Sketches, near-duplicates and tokenizers are beyond SQL; ``tests/llm`` holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
