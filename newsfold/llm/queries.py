"""Registered queries of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsfold.llm import (
    cover_tree,
    fill_middle,
    id_store,
    license_scan,
    oracle,
    packing,
    prob_minhash,
    quality,
    simplex_clusters,
    suffix_dedup,
    toxicity,
    trie_bpe,
    url_filter,
    warc_audit,
)
from newsfold.llm.scratch import Scratch
from newsfold.llm.shipping import ship
from newsfold.session import configured

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
BYTE_VOCABULARY_SIZE = 50_257


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str, **options: str) -> DataFrame:
    ship(spark)
    return configured(spark).read.options(**options).parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(_table(spark, folder, "documents"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), tokenizer_path(WORD_VOCABULARY))


def op3_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return prob_minhash.classes(_table(spark, folder, "documents"))


def op4_cover_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.search(_table(spark, folder, "embeddings"))


def op5_warc_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The pages as a WARC replica, audited against a second one that was damaged at every 97th page id."""
    return warc_audit.audited_pages(_table(spark, folder, "pages", **warc_audit.PAGE_TABLE), damage_every=97)


def op6_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return trie_bpe.encode_documents(_table(spark, folder, "documents"), tokenizer_path(WORD_VOCABULARY))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(_table(spark, folder, "pages")).drop("score")


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(_table(spark, folder, "documents"))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.report(_table(spark, folder, "documents"))


def op10_id_store(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    store = Scratch(spark, "ids").path("store")
    id_store.write_store(docs, store, tokenizer_path(BYTE_VOCABULARY), BYTE_VOCABULARY_SIZE)
    return id_store.read_documents(id_store.with_occurrence(docs.select("doc_id"), "doc_id"), store)


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op12_simplex_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return simplex_clusters.clusters(_table(spark, folder, "embeddings")).drop("compared")


def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.transform_documents(_table(spark, folder, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_cover_tree_search": op4_cover_tree_search,
    "op5_warc_audit": op5_warc_audit,
    "op6_trie_bpe": op6_trie_bpe,
    "op7_url_filter": op7_url_filter,
    "op8_license_scan": op8_license_scan,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_id_store": op10_id_store,
    "op11_toxicity": op11_toxicity,
    "op12_simplex_clusters": op12_simplex_clusters,
    "op13_fill_middle": op13_fill_middle,
}

ORACLE_SQL = oracle.SQL
