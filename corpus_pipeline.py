"""Corpus pipeline: quality, language, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; all but the last return the
columns of `documents`. Rows with null or empty text are rejected by the first stage; columns may hold nulls, and rows
may repeat. A document of which `repeated_passages` leaves nothing stays with empty text and is packed as its end id
alone. An empty table passes through as an empty table. What a stage does in other cases is said in its operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from saltmesh.llm import best_fit, language_crf, ngram_join, quality_bayes, suffix_dedup
from saltmesh.llm.shared import drop_tables, last_made, stored, table, tables_made


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the hierarchical quality classifier keeps."""
    return quality_bayes.kept_documents(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language."""
    return language_crf.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without bytes that a repeated string covers."""
    return suffix_dedup.thinned_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences."""
    return best_fit.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: No SQL has a trained classifier, a random field or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, since = table(spark, sf_dir, "documents"), tables_made()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        # What the stage and the one before it wrote is read no more.
        drop_tables(spark, since, keep=(last_made(),))
    return docs
