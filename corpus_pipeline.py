"""Corpus pipeline: toxicity, quality, near-duplicates, mixing, pieces.

Each stage takes (spark, docs, folder of the tables) and works on all documents that its predecessor kept.
Stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import mixing, pieces, quality, simhash, toxicity
from tidemark.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold, by a model of the labelled ones."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(docs, labels)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    scored = docs.select(row.alias("row"), toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.filter(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_low_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the base rule and are no outliers of their language and source."""
    return quality.kept_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.distinct_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, pieces, n_pieces, round_trip of every document of the mix."""
    return pieces.encode_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing to target weights", mix),
    ("SentencePiece encoding", encode),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over documents; each result is written and read again in the shared folder."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{base}/{number}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# Trained scores and XXH64 fingerprints are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
