"""The queries of this subpackage, by name: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embeddings, language, lines, mixing, packing, pages, simhash, suffixes, syncmers, tokens
from .common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_groups(table(spark, sf_dir, "embeddings"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest_columns(lines.without_repeats(table(spark, sf_dir, "documents")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_syncmers": op2_syncmers,
    "op3_html": op3_html,
    "op4_embeddings": op4_embeddings,
    "op5_language": op5_language,
    "op6_simhash": op6_simhash,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_mixing": op8_mixing,
    "op9_line_dedup": op9_line_dedup,
    "op10_packing": op10_packing,
}

ORACLE_SQL = {
    "op8_mixing": mixing.ORACLE,
    "op9_line_dedup": lines.ORACLE,
}
