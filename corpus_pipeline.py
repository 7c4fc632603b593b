"""A training-data pipeline over ``documents``: filters, near-duplicates, decontamination, pieces.

Each stage takes what the stage before it kept and works on all of it. All but the last give the
columns of ``documents`` back; the last gives every remaining document's pieces.

Defined results, for any row and any further columns, whatever their names: a null or empty text is
not toxic, has no language and so goes at the language stage; a text of any length is read whole;
repeated rows, and rows that share an id, are told apart by their place and are near-duplicates of
each other only if their texts are; null ids are kept like any other; a null language or source is
no reason to go; empty tables give empty results, and without a learned language no document stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundcheck.llm import decontam, langid, sentencepieces, simhash, toxicity, vocabulary
from groundcheck.llm.common import fold, stored
from groundcheck.llm.queries import PIECES, TOKENIZERS, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below 0.3."""
    learned = fold(F.col("doc_id"), 4) != 2
    model = toxicity.train(docs.where(learned), table(spark, sf_dir, "labels").where(learned))
    return toxicity.keep_clean(docs, model)


def drop_undetermined(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the documents: those that the machine of their
    own family, at least, accepts with a margin of 0.1. The README has the margins of held-out
    documents and of text in other languages."""
    return langid.keep_identified(docs, langid.train(docs.where(fold(F.col("doc_id"), 4) != 2)), least_margin=0.1)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not reach or make up less than a twentieth of."""
    return decontam.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, ids`` and whether decoding gives the text again."""
    found = sentencepieces.encode(docs, vocabulary.load(f"{TOKENIZERS}/{PIECES}"), check=True)
    return found.select(F.col("id").alias("doc_id"), "n_pieces", "ids", "round_trip")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("language_id", drop_undetermined),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: Classifiers and piece encoding can't be stated in SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
