"""Inputs derived by Spark from the driver tables (so their size grows with them).

The driver tables hold no NULL and no blank value, so the missing-value
operators run on derived frames that introduce them by rule:

* FX1 - documents LEFT JOIN labels (``quality``/``toxic`` NULL where unlabeled)
* FX2 - source-like columns computed from orders (NULLs and blanks by key rule)
* FX3 - scored labels: documents JOIN labels, ``score`` a monotone map of length

Each fixture also has its SQL text so the oracle computes the same input.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# FX2's four source-like columns (the others are a numeric and a timestamp).
FX2_SOURCE_COLUMNS = ("record_id", "kind", "name", "review")


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table (file listing and footer read once per application)."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def fx1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left")


FX1_SQL = "SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)"


def fx2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*FX2_SELECT)


# One select list, valid in both Spark SQL and the oracle's SQL dialect.
FX2_SELECT = (
    "o_orderkey AS record_id",
    "CASE WHEN o_orderkey % 7 = 0 THEN CAST(NULL AS STRING) WHEN o_orderkey % 11 = 0 THEN '  ' "
    "ELSE o_orderpriority END AS kind",
    "CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE concat('NAME ', CAST(o_custkey % 100 AS STRING)) END AS name",
    "CASE WHEN o_orderkey % 5000 = 1 THEN 'BREACHED' END AS review",
    "CASE WHEN o_orderkey % 13 = 0 THEN CAST(NULL AS DOUBLE) ELSE o_totalprice END AS amount",
    "o_orderdate AS event_ts",
)

FX2_SQL = "SELECT " + ",\n  ".join(FX2_SELECT).replace("AS STRING", "AS VARCHAR") + "\nFROM orders"


def fx3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "inner").select(
        "doc_id", "lang", "source", "n_chars",
        F.col("quality").cast("int").alias("label"),
        (F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))).alias("score"),
    )


FX3_SQL = """SELECT d.doc_id, d.lang, d.source, d.n_chars, CAST(l.quality AS INTEGER) AS label,
  CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + CAST(1000.0 AS DOUBLE)) AS score
FROM documents d JOIN labels l USING (doc_id)"""
