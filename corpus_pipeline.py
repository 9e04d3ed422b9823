"""Corpus pipeline: drop toxic documents, near-duplicates, repeated passages and leaked benchmark items, then pack.

Every stage takes an empty table and gives an empty one, and keeps further columns, whatever their names, up to
packing, which returns pieces only. Null texts count as empty; they stay null until repeated passages are cut, which makes them empty. Nothing but text, id
and labels is read, so nulls in other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import contamination, packing, simhash, suffixes, toxicity
from marketlake.llm.common import read, staged


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; equal texts are kept or dropped together.

    Null and empty texts are judged by the classifier's bias. Without labels every document stays.
    """
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), toxicity.training_rows())
    return toxicity.keep_clean(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each group of near-duplicates; null ids come last.

    Rows that share that id are ordered by text and counted once. Texts without words link with each other.
    """
    return simhash.keep_one(docs, shingle=3, bits=3)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier document or an earlier place also holds.

    A text that repeats wholly becomes empty, and its row stays. Null ids come last; n_chars is counted anew,
    and is added where the table has none. A null text becomes empty.
    """
    return suffixes.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item: below 0.8 of each item's five-word shingles.

    Null and empty texts hold none. Items that are null or have no shingle are in no document.
    """
    return contamination.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as token pieces, placed in sequences of at most 1024 tokens.

    Null and empty texts are one piece, the end id alone. Repeated rows and ids keep their own pieces.
    """
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean),
    ("simhash_dedup", distinct),
    ("suffix_dedup", unrepeated),
    ("decontamination", unleaked),
    ("packing", packed),
]

#: Trained weights and hash searches have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
