"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm.chat import format_chats
from textloom.llm.common import table
from textloom.llm.decontamination import LEAKS_SQL, leaks_query
from textloom.llm.divergence import DIVERGENCE_SQL, audit_divergence
from textloom.llm.line_dedup import LINES_SQL, lines_query
from textloom.llm.mixing import MIXING_SQL, mixing_query
from textloom.llm.parsing import compare_with_next
from textloom.llm.quality import score_quality
from textloom.llm.secrets import scan_secrets
from textloom.llm.simhash import simhash_near_duplicates
from textloom.llm.spelling import SPELLING_SQL, group_spellings
from textloom.llm.substring_dedup import PASSAGES_SQL, remove_repeated_passages
from textloom.llm.toxicity import score_toxicity
from textloom.llm.warc import WARC_SQL, archive_pages


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_duplicates(table(spark, sf_dir, "documents"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_query(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_query(table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_divergence(table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_secret_scans": op7_secret_scans,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_source_divergence": op12_source_divergence,
    "op13_warc": op13_warc,
}

ORACLE_SQL = {
    "op3_substring_dedup": PASSAGES_SQL,
    "op4_benchmark_decontamination": LEAKS_SQL,
    "op5_line_dedup": LINES_SQL,
    "op6_source_mixing": MIXING_SQL,
    "op11_spelling_variants": SPELLING_SQL,
    "op12_source_divergence": DIVERGENCE_SQL,
    "op13_warc": WARC_SQL,
}
