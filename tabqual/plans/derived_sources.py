"""Raw-format copies of driver tables, written by Spark into the shared folder.

The source readers are checked on files Spark derives from the given tables,
so the work grows with them: CSV and JSON-lines copies, GeoJSON
FeatureCollections, ``{"results": [...]}`` wrappers and JSON lines with
damaged records. Collections group rows by ``event_id`` ranges of a fixed
width, so a collection never holds more than that many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabqual.session import shared_path
from tabqual.sources import files

# Rows per written collection, and the id rule that marks a
# JSON line to be damaged (its closing brace removed).
ROWS_PER_COLLECTION = 1000
DAMAGE_EVERY = 97
# Timestamp text format that keeps microseconds.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_csv_copy(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = shared_path(spark, name)
    (df.write.option("header", True).option("timestampFormat", TS_FORMAT)
       .option("timestampNTZFormat", TS_FORMAT).csv(path))
    return path


def write_json_copy(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = shared_path(spark, name)
    df.write.option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_FORMAT).json(path)
    return path


def _collections(events: DataFrame, item: F.Column, wrapper: str, kind: str | None) -> DataFrame:
    chunk = F.floor(F.col("event_id") / F.lit(ROWS_PER_COLLECTION))
    grouped = events.groupBy(chunk.alias("_chunk")).agg(F.collect_list(item).alias(wrapper))
    fields = ([F.lit(kind).alias("type")] if kind else []) + [F.col(wrapper)]
    return grouped.select(F.to_json(F.struct(*fields)).alias("value"))


def event_feature(events_cols=("event_id", "user_id", "event_type", "value")) -> F.Column:
    """A GeoJSON Feature per event; ``error`` events carry no geometry."""
    geometry = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(
        F.struct(F.lit("Point").alias("type"),
                 F.array(F.col("value"), F.col("user_id").cast("double")).alias("coordinates")))
    return F.struct(F.lit("Feature").alias("type"),
                    F.struct(*[F.col(c) for c in events_cols]).alias("properties"),
                    geometry.alias("geometry"))


def feature_collections(events: DataFrame) -> DataFrame:
    """One FeatureCollection per row, as text."""
    return _collections(events, event_feature(), "features", "FeatureCollection")


def arrays(events: DataFrame, item: F.Column) -> DataFrame:
    """One JSON document per row: a top-level array for every other group of rows, a wrapped array for the rest."""
    chunk = F.floor(F.col("event_id") / F.lit(ROWS_PER_COLLECTION)).alias("chunk")
    grouped = events.groupBy(chunk).agg(F.collect_list(item).alias("results"))
    return grouped.select(F.when(F.col("chunk") % 2 == 0, F.to_json("results"))
                          .otherwise(F.to_json(F.struct("results"))).alias("value"))


def write_documents(spark: SparkSession, documents: DataFrame, name: str) -> str:
    """One file per document, broken over lines before every nested object."""
    path = shared_path(spark, name)
    pretty = F.regexp_replace("value", r"\{", "\n  {").alias("value")
    documents.select(pretty).write.option("maxRecordsPerFile", 1).text(path)
    return path


def write_geojson_lines(spark: SparkSession, events: DataFrame) -> str:
    """One FeatureCollection per line."""
    path = shared_path(spark, "events-geojson")
    _collections(events, event_feature(), "features", "FeatureCollection").write.text(path)
    return path


def write_results_lines(spark: SparkSession, events: DataFrame) -> str:
    """One ``{"results": [...]}`` document per line."""
    path = shared_path(spark, "events-results")
    item = F.struct("event_id", "user_id", "event_type", "value")
    _collections(events, item, "results", None).write.text(path)
    return path


def write_damaged_json_lines(spark: SparkSession, events: DataFrame) -> str:
    """JSON lines where every ``DAMAGE_EVERY``-th id loses its closing brace."""
    path = shared_path(spark, "events-damaged")
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    damaged = F.when(F.col("event_id") % DAMAGE_EVERY == 0, F.expr("substring(value_json, 1, length(value_json) - 1)"))
    out = (events.select("event_id", line.alias("value_json"))
                 .select(F.coalesce(damaged, F.col("value_json")).alias("value")))
    out.write.text(path)
    return path


def write_one_document(spark: SparkSession, rows: DataFrame, key: str, item: F.Column, head: str, tail: str, name: str,
                       part_bytes: int = files.PART_BYTES) -> str:
    """One file of one JSON document: ``head``, the item of every row in the order of ``key`` over many lines, ``tail``.

    Many tasks write the file, each its own part. In stores that cannot write at a place in a file, one task writes it all.
    """
    path = shared_path(spark, name)
    text = F.concat(F.lit("\n  "), F.regexp_replace(F.to_json(item), r":\{", ":\n  {"))
    if files.writes_anywhere(path):
        lines = rows.select(F.col(key).alias("at"), F.concat(F.lit(","), text, F.lit("\n")).alias("value"))
        files.write_in_order(lines, f"{path}/part-00000.txt", f"{head}\n".encode(), f"{tail}\n".encode(), len(b","), part_bytes)
        return path
    first = rows.agg(F.min(key)).first()[0]
    comma = F.when(F.col(key) == F.lit(first), "").otherwise(",")
    body = rows.select(F.lit(1).alias("part"), F.col(key).alias("at"), F.concat(comma, text).alias("value"))
    ends = spark.range(2).select((F.col("id") * 2).cast("int").alias("part"), F.lit(0).cast("bigint").alias("at"),
                                 F.when(F.col("id") == 0, head).otherwise(tail).alias("value"))
    body.unionByName(ends).coalesce(1).sortWithinPartitions("part", "at").select("value").write.text(path)
    return path


# Rows of ``pages`` in a written file of the landing folder, and the kinds of its files.
ROWS_PER_LANDED_FILE = 600
LANDED_LINE = f"""CASE page_id % 6
  WHEN 0 THEN concat(CAST(page_id AS STRING), ',', CAST(length(url) AS STRING))
  WHEN 1 THEN concat('{{"page_id": ', CAST(page_id AS STRING), '}}')
  WHEN 2 THEN concat(CASE WHEN page_id % {ROWS_PER_LANDED_FILE} < 6 THEN '[' ELSE ',' END, '{{"page_id": ', CAST(page_id AS STRING), '}}')
  WHEN 3 THEN CASE WHEN page_id % {ROWS_PER_LANDED_FILE} < 6 THEN '{{' WHEN page_id % {ROWS_PER_LANDED_FILE} >= {ROWS_PER_LANDED_FILE} - 6
    THEN '"type": "FeatureCollection"}}' ELSE concat('"', CAST(page_id AS STRING), '": 1,') END
  WHEN 4 THEN CASE WHEN page_id % {ROWS_PER_LANDED_FILE} < 6 THEN '{{"type": "FeatureCollection", "features": [' ELSE concat('{{"id": ', CAST(page_id AS STRING), '}},') END
  ELSE concat('page ', CAST(page_id AS STRING)) END"""


def write_landing_folder(spark: SparkSession, pages: DataFrame) -> str:
    """Files of six kinds, named alike, in folders ``kind=../bucket=..``: what they hold, only their content tells."""
    path = shared_path(spark, "landing")
    rows = pages.selectExpr("page_id", f"{LANDED_LINE} AS value", "page_id % 6 AS kind", f"page_id div {ROWS_PER_LANDED_FILE} AS bucket")
    dealt = rows.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", "page_id")
    dealt.select("value", "kind", "bucket").write.partitionBy("kind", "bucket").text(path)
    return path
