"""Corpus pipeline: from raw documents to a deduplicated, mixed, tokenised corpus.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet into the shared folder and rereads them as the next
stage's input. All stages but the last return the columns of documents.

ORACLE_SQL is None: language ID learns its model, the SimHash components need
a closure over bit distances, the mix solves a convex dual and the pieces come
from a model file. Each stage is tested against a brute-force version instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitfit.llm import exact_dedup, langid, mixing, pieces, simhash
from orbitfit.llm.base import fold, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; the model learns from the labelled table's training folds."""
    known = table(spark, sf_dir, "documents")
    return langid.keep_identified(docs, known.filter(fold(F.col("doc_id"), 4) != 2))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts: the smallest doc_id."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest doc_id."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, checked by decoding them."""
    return pieces.encode(docs, check=True)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing sources", mix),
    ("SentencePiece", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
