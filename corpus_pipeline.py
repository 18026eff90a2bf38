"""Corpus pipeline: language ID, near-duplicates, decontamination, personal data, mix of sources.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabqual.llm import decontaminate, language, mixing, simhash, surrogates
from tabqual.llm.shared import crc_mod, read_table, save


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a language: NULL texts and texts without a letter."""
    model = language.learn(docs, F.coalesce(crc_mod("doc_id", 5) != 0, F.lit(False)))
    return language.drop_unknown(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component, the one with the smallest id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a benchmark item."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts surrogates in the place of personal data; ``n_chars`` follows the new text."""
    out = surrogates.replace_entities(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken, numbered in ``copy``."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii_surrogates", replace_personal_data),
    ("source_mix", mix_sources),
]

#: Trained machines and hashed fingerprints have no SQL form; tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
