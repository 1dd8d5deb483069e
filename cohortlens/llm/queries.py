"""One query per training-data operator over its whole table, with production
parameters, and the DuckDB statement where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import chat, embedding_dedup, exact_dedup, language_id, mixing, ngram_join, packing, pii, quality, secrets_scan, spelling, token_files, whitening
from cohortlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str | None] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name], ORACLES[name] = fn, sql
        return fn

    return register


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


@query("op2_chat_format", chat.SQL)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return chat.digest(given.unionByName(chat.control_case(spark)))


@query("op3_embedding_dedup", embedding_dedup.SQL)
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicate(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query("op4_source_mixing", mixing.SQL)
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_files.read(token_files.write(docs, public_tokenizers.path(token_files.TOKENIZER)))


@query("op6_ngram_jaccard_join", ngram_join.SQL)
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op7_pii_spans")
def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query("op11_exact_dedup", exact_dedup.SQL)
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op12_spelling_variants", spelling.SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
