"""The numbered queries, each an operator applied to its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agora.llm import ann, conversations, decontaminate, html_text, langid, licenses, lm, minhash, mixing, negatives, pii, sharding, toxicity
from agora.llm.text import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.document_components(table(spark, sf_dir, "documents"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.document_scores(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.document_spans(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.document_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(table(spark, sf_dir, "documents"))


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.document_languages(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.conversation_repairs(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.document_licenses(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_language_model": op2_language_model,
    "op3_personal_data": op3_personal_data,
    "op4_toxicity": op4_toxicity,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_mix_sources": op6_mix_sources,
    "op7_feistel_shards": op7_feistel_shards,
    "op8_page_text": op8_page_text,
    "op9_language": op9_language,
    "op10_decontaminate": op10_decontaminate,
    "op11_repair_conversations": op11_repair_conversations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_licenses": op13_licenses,
}

ORACLE: dict[str, str] = {
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_repair_conversations": conversations.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
}
