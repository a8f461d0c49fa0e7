"""Corpus preparation: language, repeated lines, near duplicates, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir) with the columns of ``documents`` and returns a DataFrame; all but the last keep
these columns. A stage's result is written as Parquet and read again as the next one's documents. Repeated rows are decided
alike up to the join, which keeps one row of each group; empty tables pass through as empty results; columns beyond those of
``documents`` are dropped at the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlas.llm import decontamination, jaccard_join, language_id, line_dedup, packing
from atlas.llm.common import staged, table, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Scores are scaled so that the median training row is 95 % sure of each pair: 0.91 with two families of two. A sample of 2 400
# labelled training rows at sf0.1 begins at 0.40; letters of no learned language stay near 0.25, what even choices give.
LEAST_SCORE = 0.36


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters that are clearly in a learned language; lang stays as it was given."""
    docs = docs.select(*COLUMNS)
    found = language_id.identify(docs, language_id.train(docs))
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines whose template recurs go from all but its first document, and n_chars follows."""
    found = line_dedup.drop_recurring_lines(docs, min_tokens=line_dedup.EVERY_LINE)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, that of the least doc_id; documents without words stay."""
    return jaccard_join.representatives(docs).select(*COLUMNS)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word benchmark window."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids and places in sequences of 2048 tokens."""
    return packing.packed(docs, tokenizer_path(spark, "word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("language_id", in_known_language),
    ("line_dedup", without_recurring_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("decontamination", without_leaks),
    ("packing", in_sequences),
]
ORACLE_SQL = None   # language identification, near duplicates and the tokenizer are beyond SQL; tests hold brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
