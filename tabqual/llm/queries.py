"""Registered queries of the operators, each over its whole table, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabqual.llm import (decontaminate, imatch, language, mixing, search, secrets, sharding, simhash, spelling, suffixes,
                         surrogates, toxicity, urls)
from tabqual.llm.shared import crc_mod, read_table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains."""
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    pages = read_table(spark, sf_dir, "pages")
    return urls.UrlFilter().fit(pages).judge(pages)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, from machines trained on the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = language.learn(docs, crc_mod("doc_id", 5) != 0)
    held = docs.select("doc_id", "text", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"))
    tagged = held.select(F.struct("doc_id", "held_out").alias("row"), "text")
    return language.identify(tagged, model, id_col="row").select("row.*", "lang_pred", "score")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document, and the digest of the rest."""
    return suffixes.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.plan(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return imatch.compare_with_edits(read_table(spark, sf_dir, "documents"))


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates for personal data."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs).select("doc_id", "n_entities", "text")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels that are not held out; so are the machines that tell its language."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    tongues = language.learn(docs, crc_mod("doc_id", 3) != 1, sample_per_language=300)
    known = labels.filter(crc_mod("doc_id", 3) != 1).select("doc_id", "toxic")
    model = toxicity.learn(docs, known, languages=tongues)
    tagged = docs.select(F.struct("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out")).alias("row"), "text")
    return toxicity.score(tagged, model, id_col="row").select("row.*", "score", "predicted")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by the law of equal bytes."""
    placed = sharding.assign_shards(read_table(spark, sf_dir, "documents"))
    return placed.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, root and near words of every frequent word, one in 97 words of a document having lost a letter."""
    runs = spelling.runs(read_table(spark, sf_dir, "documents"))
    return spelling.group_variants(spelling.count_words(spelling.with_slips(runs, 97)))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents for every benchmark item."""
    index = search.build_index(read_table(spark, sf_dir, "documents"))
    return search.search(index, read_table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "item_id")


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_decontamination, op2_url_filter, op3_language_id, op4_suffix_dedup, op5_simhash, op6_source_mix, op7_imatch, op8_surrogates,
    op9_secrets, op10_toxicity, op11_sharding,
    op12_spelling_variants, op13_search)}

ORACLE_SQL: dict[str, str] = {
    "op6_source_mix": mixing.PLAN_SQL.format(documents="documents")
    + "SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed",
    "op11_sharding": sharding.SHARDS_SQL.format(documents="documents"),
    "op13_search": search.SEARCH_SQL.format(documents="documents", benchmark="benchmark"),
    "op12_spelling_variants": spelling.VARIANTS_SQL.format(documents="documents"),
}
