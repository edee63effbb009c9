"""From raw documents to training sequences: five stages, each the whole table of the one before."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from segmint.llm import decontaminate, exact_dedup, near_dedup, packing, quality_pu
from segmint.llm.common import ship, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled rows outside the held-out fold."""
    ship(spark)
    weights, _ = quality_pu.fit(docs, table(spark, sf_dir, "labels"))
    return quality_pu.keep_good(docs, weights)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    ship(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the smallest doc_id stays."""
    ship(spark)
    return near_dedup.keep_one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    ship(spark)
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document as unpadded power-of-two sequences, ids as bytes."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("minhash_near_dedup", near),
    ("benchmark_decontamination", decontaminated),
    ("packing", sequences),
]
#: No SQL can train the classifier or run the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
