"""A training-data pipeline: each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from terraloom.llm.queries import table
from terraloom.llm.shield import shielded
from terraloom.session import discard, handed_out, new_dir, ship

def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    safe, restore = shielded(docs, ("doc_id", "text"))
    return quality.score_quality(safe, model).where(F.col("score") >= quality.THRESHOLD).select(*restore())


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; ``n_chars`` follows the text. A document of copies only goes."""
    safe, restore = shielded(docs, ("doc_id", "text", "n_chars"))
    left = line_dedup.dedup_lines(safe).where(F.size("gone") < F.greatest("n_lines", F.lit(1)))
    if "n_chars" not in docs.columns:
        return left.select(*restore())
    chars = F.when(F.size("gone") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return left.select(*restore(n_chars=chars))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates."""
    ship(spark)
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages to speak of."""
    ship(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, with ``copy`` counted from 0."""
    return mixing.mix(docs)


STAGES = [
    ("quality", classify_quality),
    ("line dedup", dedup_lines),
    ("n-gram join", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The classifier's decisions cannot be expressed in SQL; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote on the way goes once its result is stored."""
    docs, earlier = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        before = handed_out(spark)
        path = new_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        discard(spark, [*earlier, *(p for p in handed_out(spark) if p not in before and p != path)])
        docs, earlier = spark.read.parquet(path), [path]
    return STAGES[-1][1](spark, docs, sf_dir)
