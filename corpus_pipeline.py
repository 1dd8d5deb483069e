"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and reread as the next one's input.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept.  All but the last return the columns of ``docs``; the last
returns packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import language_id, mixing, ngram_join, packing, secrets_scan
from cohortlens.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the rest go."""
    return language_id.keep_identified(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return ngram_join.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    return secrets_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences, a row each, with their documents' ids and texts."""
    return packing.sequences(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", one_of_near_copies),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


#: The language model, the network and the packer have no SQL form.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
