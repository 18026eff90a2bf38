"""Reports of a table from the job that writes it.

Counts are observed (``DataFrame.observe``) on the rows that go into the files, behind the write's shuffle: in that last stage Spark
counts each finished task once, however often tasks are tried. So validation, totals, bands and missing values need no scan of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tabqual.functions.columns import sql_str
from tabqual.functions.literals import literal_table
from tabqual.functions.missing import missing_count, missing_flag_sql
from tabqual.operators.quality import QUALITY_BANDS, ValidationError


@dataclass
class WriteMetrics:
    """What was observed of a written table; every report has one row for each column or band at most."""

    spark: SparkSession
    rows: int
    empty_rows: int
    avg_completeness: float | None
    bands: dict[str, int]
    missing: dict[str, int]
    source_columns: int

    def validation(self) -> DataFrame:
        """As :func:`quality.ingestion_validation` of the source."""
        return literal_table(self.spark, [(self.rows, self.source_columns, self.empty_rows)],
                             "total_rows bigint, total_columns int, completely_empty_rows bigint")

    def assert_valid(self) -> dict:
        """The validation as a dict; no rows or no columns are an error."""
        if self.source_columns == 0:
            raise ValidationError("input has no columns")
        if self.rows == 0:
            raise ValidationError("input is empty")
        return {"total_rows": self.rows, "total_columns": self.source_columns, "completely_empty_rows": self.empty_rows}

    def totals(self) -> DataFrame:
        """As :func:`profile.summary_totals`."""
        return literal_table(self.spark, [(self.rows, self.avg_completeness)], "total_records bigint, avg_completeness double")

    def band_distribution(self) -> DataFrame:
        """As :func:`profile.group_count_desc` of ``quality_band``; bands without rows are left out."""
        held = sorted(((b, n) for b, n in self.bands.items() if n), key=lambda x: (-x[1], x[0]))
        return literal_table(self.spark, held, "quality_band string, records bigint")

    def null_profile(self) -> DataFrame:
        """As :func:`profile.null_profile` of the written table."""
        rows = sorted(((c, n, n / self.rows if self.rows else 0.0) for c, n in self.missing.items()), key=lambda x: (-x[2], x[0]))
        return literal_table(self.spark, rows, "column string, null_count bigint, null_ratio double")


def _sibling(spark: SparkSession) -> SparkSession:
    """A session of the same application and settings, for observing alone.

    A session that has observed anything holds its observations in a field that Spark ML's training summaries
    cannot serialise, so models could no longer be fitted and applied in it.
    """
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def write_observed(curated: DataFrame, write: Callable[[DataFrame], None], source_columns: Sequence[str],
                   bands: Sequence[str] = tuple(b for b, _ in QUALITY_BANDS)) -> WriteMetrics:
    """Run ``write`` on ``curated`` and return what was observed of its rows.

    ``write`` must not shuffle the frame it gets: lay the rows out before (:func:`curate.layout_for_write`). ``source_columns`` are the
    columns whose rows may be wholly empty. A table without rows is written as such, with counts of 0.
    """
    cols = list(curated.columns)
    empty = (missing_count(list(source_columns)) == len(source_columns)) if source_columns else F.lit(False)
    metrics = [F.count(F.lit(1)).alias("rows"), F.sum(F.when(empty, 1).otherwise(0)).alias("empty")]
    metrics += [F.sum(F.expr(missing_flag_sql(c))).alias(f"m{i}") for i, c in enumerate(cols)]
    if "completeness_ratio" in cols:
        metrics.append(F.avg("completeness_ratio").alias("completeness"))
    if "quality_band" in cols:
        metrics += [F.sum(F.expr(f"CASE WHEN quality_band = {sql_str(b)} THEN 1 ELSE 0 END")).alias(f"b{i}") for i, b in enumerate(bands)]
    seen, view, spark = Observation(), f"observed_{uuid.uuid4().hex}", curated.sparkSession
    curated.createGlobalTempView(view)
    try:
        write(_sibling(spark).table(f"global_temp.{view}").observe(seen, *metrics))
    finally:
        spark.catalog.dropGlobalTempView(view)
    got = seen.get
    return WriteMetrics(spark, int(got.get("rows") or 0), int(got.get("empty") or 0), got.get("completeness"),
                        {b: int(got.get(f"b{i}") or 0) for i, b in enumerate(bands)} if "quality_band" in cols else {},
                        {c: int(got.get(f"m{i}") or 0) for i, c in enumerate(cols)}, len(source_columns))
