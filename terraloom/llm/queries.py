"""The registered queries of these operators, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, conversation_repair, decontaminate, filter_audit, html_extract, licenses, line_dedup, mixing, ngram_join, quality, tokens,
    toxicity, vector_dedup,
)
from .oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = tokens.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.vector_links(table(spark, sf_dir, "embeddings"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_links(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat.chat_report(rows.unionByName(extra))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (op1_quality, op2_tokens, op3_toxicity, op4_decontaminate, op5_vector_dedup, op6_ngram_join, op7_licenses, op8_line_dedup,
               op9_chat, op10_mixing, op11_conversation_repair, op12_html_text, op13_filter_audit)
}
__all__ = ["ORACLE", "QUERIES", "table"]
