"""A corpus in five stages, each of which calls one operator of ``pagewright.llm``.

Quality classifier, exact dedup, near dedup, mixing, packing: each stage works
on what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import exact_dedup, mixing, near_dedup, packing, quality_classifier
from pagewright.llm.common import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within the limit of their language."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.filter_documents(docs.select(*COLUMNS), labels)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    found = exact_dedup.exact_dedup(docs, carry=["text", "lang", "source", "n_chars"])
    return found.where("kept").select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.kept_documents(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as their source's target asks for."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences: one row per piece, with its token ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [("quality_classifier", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack)]

#: Streams, signatures and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
