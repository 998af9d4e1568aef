"""Corpus pipeline: quality, near copies, repeated passages, source mixing, packing.

Each stage takes the rows the one before kept. All but the last return the
columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstone.llm import linecrf, mixing, packing, repeats, simhash
from wardstone.llm.common import DOCUMENT_COLUMNS, table
from wardstone.llm.queries import GOOD, MAX_REPETITION
from wardstone.llm.tokens import public_tokenizer
from wardstone.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines the random field finds good."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return linecrf.keep(docs.select(*DOCUMENT_COLUMNS), linecrf.train(docs, labels), GOOD)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the one with the smallest id.

    It is decided by row: rows without an id come last and go like others, rows
    that share an id are judged each by their own text, and of equal rows one stays.
    """
    return simhash.keep_one(docs.select(*DOCUMENT_COLUMNS), shingle=4, seed=42, radius=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier; a document that is nothing else stays, empty."""
    return repeats.clean_documents(docs.select(*DOCUMENT_COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources repeated up to the limit; every document stays at least once."""
    return mixing.mix(docs, max_repetition=MAX_REPETITION, columns=DOCUMENT_COLUMNS).select(*DOCUMENT_COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizer(), end_id=1, capacity=2048)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_copies),
    ("suffix_array_dedup", repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The stages hash, encode and classify; tests hold them against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
