"""Sinks: partitioned and plain Parquet, report CSV, lineage log, models, plans.

Writers never rename or move files on the driver; a report is a directory
written by Spark. Intermediate tables go below the shared folder
(:func:`tabqual.session.shared_path`).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabqual.operators.curate import layout_for_write


def write_partitioned_parquet(df: DataFrame, path: str,
                              partition_cols: Sequence[str] = ("ingest_year", "ingest_month"),
                              layout: str | None = "rebalance", mode: str = "overwrite") -> None:
    """Partitioned Parquet; with ``overwrite`` only the partitions present are replaced
    (a per-write option, so concurrent jobs of the session are unaffected). ``layout=None``: rows are laid out already."""
    ((layout_for_write(df, partition_cols, method=layout) if layout else df)
        .write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols).parquet(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_report_csv(df: DataFrame, path: str, single_file: bool = True, quote_all: bool = False) -> None:
    """Report-sized frames as CSV with a header, in one part file; pass ``single_file=False`` for any other frame."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite").option("header", True)
    if quote_all:
        writer = writer.option("quoteAll", True)
    writer.csv(path)


def sample_export(df: DataFrame, path: str, key: Sequence[str], n: int = 500) -> DataFrame:
    """First ``n`` rows by ``key`` written as fully quoted CSV; returns the sample."""
    sample = df.orderBy(*key).limit(n)
    write_report_csv(sample, path, single_file=True, quote_all=True)
    return sample


LINEAGE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("step", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("timestamp_utc", T.TimestampType(), False),
    T.StructField("details", T.MapType(T.StringType(), T.StringType()), True),
])


def lineage_record(spark: SparkSession, run_id: str, step: str, status: str,
                   details: Mapping[str, object] | None = None, at: dt.datetime | None = None) -> DataFrame:
    when = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    detail = {str(k): (v if isinstance(v, str) else json.dumps(v)) for k, v in (details or {}).items()}
    return spark.createDataFrame([(run_id, step, status, when, detail)], LINEAGE_SCHEMA)


def log_lineage(spark: SparkSession, path: str, run_id: str, step: str, status: str,
                details: Mapping[str, object] | None = None, attempt: int = 0, at: dt.datetime | None = None) -> None:
    """Record one step of a run; see :func:`upsert_lineage`."""
    upsert_lineage(lineage_record(spark, run_id, step, status, details, at), path, attempt)


def upsert_lineage(records: DataFrame, path: str, attempt: int = 0) -> None:
    """Store step records (``LINEAGE_SCHEMA``; any number for each run and step), as those of attempt ``attempt``.

    Run, step and attempt are the key: storing an attempt again replaces its records, so a retried write adds nothing. Files are
    staged by Spark and come into place when the write commits; every record says how many its run, step and attempt have, and readers pass over
    an attempt that lacks some.
    """
    sizes = records.groupBy("run_id", "step").agg(F.count(F.lit(1)).alias("records"))
    keyed = records.join(sizes, ["run_id", "step"]).withColumn("attempt", F.lit(attempt))
    (keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "step", "attempt").parquet(path))


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    """The records of every run and step, by its last whole attempt: a late write of an earlier attempt changes nothing."""
    stored = T.StructType(LINEAGE_SCHEMA.fields + [T.StructField("records", T.LongType()), T.StructField("attempt", T.IntegerType())])
    rows = spark.read.schema(stored).parquet(path)
    whole = rows.groupBy("run_id", "step", "attempt").agg((F.count(F.lit(1)) == F.max("records")).alias("whole")).where("whole")
    last = whole.groupBy("run_id", "step").agg(F.max("attempt").alias("attempt"))
    return rows.join(last, ["run_id", "step", "attempt"], "left_semi").select(*LINEAGE_SCHEMA.fieldNames(), "attempt")


def lineage_status(lineage: DataFrame) -> DataFrame:
    """Number of steps of every run, those with a record that is not ``ok``, and the time of the last record."""
    steps = lineage.groupBy("run_id", "step").agg(F.max((F.col("status") != "ok").cast("int")).alias("failed"),
                                                  F.max("timestamp_utc").alias("at"))
    return steps.groupBy("run_id").agg(F.count(F.lit(1)).alias("steps"), F.sum("failed").cast("bigint").alias("failed_steps"),
                                       F.max("at").alias("last_update"))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def plan_text(df: DataFrame, mode: str = "extended") -> str:
    """The text ``DataFrame.explain(mode)`` prints (no execution): ``extended`` gives
    the parsed, analyzed, optimized and physical plans."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
