"""From documents to training sequences: five stages, each over all that the one before kept.

Every stage but the last returns the columns of documents. Between stages
the rows are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.llm import language, lines, mixing, near, packing
from kinmatch.llm.common import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Proportion of its main language under which a document of several ones goes: clearly more than half.
MAIN_LANGUAGE = 0.6


def _identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those of which no language has most: a share of at least MAIN_LANGUAGE.

    Where nothing is labelled, nothing can be told and all stay.
    """
    docs = docs.select(*COLUMNS)
    model = language.learn(docs)
    if not model.languages:
        return docs
    found = language.with_language(docs, model, ("found", "share"))
    return found.where((F.col("found") != language.UNKNOWN) & (F.col("share") >= MAIN_LANGUAGE)).select(*COLUMNS)


def _drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, of smallest doc_id, of each group of near-duplicates: SimHash links and shared shingles, at a similarity of five-word shingles of 0.8 or more."""
    return near.one_of_each_group(docs.select(*COLUMNS))


def _drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes from each text the passages that came before, wherever they stand, and the lines, short ones too; n_chars follows the text."""
    out = lines.without_repeats(docs.select(*COLUMNS), (*lines.PASSAGES, ("line", 1)), carry=("lang", "source"))
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def _mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's target weight asks for."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs every row into sequences of at most 2048 tokens."""
    return packing.packed_documents(docs.select(*COLUMNS))


STAGES = [
    ("language", _identify_language),
    ("near_duplicates", _drop_near_duplicates),
    ("repeated_lines", _drop_repeated_lines),
    ("mixing", _mix_sources),
    ("packing", _pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs


#: Language identification and packing are no SQL; tests hold the rows against a plain version.
ORACLE_SQL = None
