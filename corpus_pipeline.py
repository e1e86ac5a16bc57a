"""A corpus pipeline: each stage takes the documents its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinspark.llm import exact_dedup, mixing, pieces, quality_rules, simhash
from clinspark.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


KEEP_SCORE = 0.3


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules, fitted on the labels beside them, do not reject."""
    model = quality_rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.accepted(docs, model, KEEP_SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, the one with the smallest id stays."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group, the document with the smallest id stays."""
    return simhash.without_near_copies(docs, shingle_words=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's pieces, and of the text they decode to."""
    import public_tokenizers

    return pieces.digests(pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model")))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", drop_poor),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("pieces", encode_pieces),
]

# Trained models and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
