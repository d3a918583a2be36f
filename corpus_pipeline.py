"""From documents to sampled encodings, in five stages over the whole corpus.

Each stage reads what its predecessor kept, written as Parquet. All but the last
return the columns of ``documents``; the last returns one row per kept document and
sampled segmentation.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from footfall.llm.common import table
from footfall.llm.decontamination import drop_contaminated
from footfall.llm.exact_dedup import drop_exact_duplicates
from footfall.llm.language import keep_known_languages
from footfall.llm.near_dedup import drop_near_duplicates
from footfall.llm.segmentation import sampled_segmentations
from footfall.session import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has no letter, or no language that the network holds likely, go."""
    return keep_known_languages(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return drop_near_duplicates(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encodings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document, checked by decoding."""
    return sampled_segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("sentencepiece", encodings),
]

#: The trained network, tensored MinHash and sampling have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
