"""Registered queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from grouprank.llm.ann import nearest
from grouprank.llm.common import documents
from grouprank.llm.conversation_repair import repair_damaged
from grouprank.llm.decontamination import contaminated
from grouprank.llm.html_text import extract_text
from grouprank.llm.jaccard_join import jaccard_classes
from grouprank.llm.language_id import language_id
from grouprank.llm.lm_scoring import score_documents
from grouprank.llm.minhash_dedup import minhash_components
from grouprank.llm.packing import pack_documents
from grouprank.llm.spelling_variants import document_variants
from grouprank.llm.suffix_dedup import remove_repeats
from grouprank.llm.token_counts import token_counts
from grouprank.llm.token_matrix import token_matrices


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_matrices(documents(spark, sf_dir))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(documents(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_variants(documents(spark, sf_dir))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_token_counts": op3_token_counts,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_decontamination": op6_decontamination,
    "op7_token_matrices": op7_token_matrices,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_language_id": op9_language_id,
    "op10_html_text": op10_html_text,
    "op11_minhash_dedup": op11_minhash_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLE_SQL: dict[str, str] = {}
