"""A training corpus from raw documents: five stages in order, each over all that the one before kept.

Every stage but the last returns the columns of ``documents``. Where a stage changes texts, ``n_chars``
follows if the table has it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import documents, staged
from changeloom.llm.packing import pack
from changeloom.llm.quality import good
from changeloom.llm.queries import importable
from changeloom.llm.repeats import without_repeats
from changeloom.llm.secrets import redact
from changeloom.llm.simhash import without_near_duplicates


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the divergence from every language reject go."""
    importable(spark)
    return good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that are alike by 0.8 or more the document with the smallest id stays."""
    importable(spark)
    return without_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document holds are cut from the text."""
    importable(spark)
    return _measured(without_repeats(docs))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced by a mark."""
    importable(spark)
    return _measured(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, one row per piece with its ids."""
    importable(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("secret scans", secret_scans),
    ("packing", packing),
]

#: Tokenisation, fingerprints and digests are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
