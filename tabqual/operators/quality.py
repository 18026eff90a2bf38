"""Row completeness, quality bands and ingestion validation.

All row-level work is plain column expressions, so it runs inside whole-stage
codegen, needs no shuffle, and works unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabqual.functions.columns import first_name_column, quote, sql_str
from tabqual.functions.literals import literal_table
from tabqual.functions.missing import completeness_ratio, missing_count, non_empty_count

# Quality bands and their inclusive lower bounds on the
# completeness ratio, highest first. The last band catches everything else.
QUALITY_BANDS = (("HIGH", 0.85), ("MEDIUM", 0.60), ("LOW", 0.0))

BAND_SCHEMA = T.StructType([
    T.StructField("quality_band", T.StringType(), False),
    T.StructField("min_ratio", T.DoubleType(), False),
])


class RowProfileTransformer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``non_empty_fields``, ``completeness_ratio`` and ``name_length``.

    ``columns`` defaults to every input column. With no columns the ratio is
    1.0 and ``non_empty_fields`` is 0 (no ``name_length`` then).
    """

    columns = Param(Params._dummy(), "columns", "source columns scored for completeness",
                    typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, columns: list[str] | None = None):
        super().__init__()
        kwargs = self._input_kwargs
        self._set(**{k: v for k, v in kwargs.items() if v is not None})

    @keyword_only
    def setParams(self, columns: list[str] | None = None):
        kwargs = self._input_kwargs
        return self._set(**{k: v for k, v in kwargs.items() if v is not None})

    def getColumns(self) -> list[str] | None:
        return self.getOrDefault(self.columns) if self.isDefined(self.columns) else None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.getColumns()
        if cols is None:
            cols = list(dataset.columns)
        return add_row_profile(dataset, cols)


def add_row_profile(df: DataFrame, columns: Sequence[str] | None = None,
                    with_name_length: bool = True) -> DataFrame:
    """Append completeness features computed over ``columns`` (default: all)."""
    cols = list(df.columns if columns is None else columns)
    if not cols:
        return df.withColumns({"non_empty_fields": F.lit(0), "completeness_ratio": F.lit(1.0)})
    out = {
        "non_empty_fields": non_empty_count(cols),
        "completeness_ratio": completeness_ratio(cols),
    }
    if with_name_length:
        out["name_length"] = name_length(cols)
    return df.withColumns(out)


def name_length(columns: Sequence[str]) -> Column:
    """Untrimmed length of the first column whose name contains "name"; 0 if none."""
    name_col = first_name_column(columns)
    if name_col is None:
        return F.lit(0)
    return F.expr(f"length(coalesce(CAST({quote(name_col)} AS STRING), ''))")


def band_dimension(spark: SparkSession, bands: Sequence[tuple[str, float]] = QUALITY_BANDS) -> DataFrame:
    """The quality dimension: one row per band (its size is the band list, a parameter)."""
    return literal_table(spark, [(b, float(r)) for b, r in bands], BAND_SCHEMA)


def band_range_dimension(spark: SparkSession,
                         bands: Sequence[tuple[str, float]] = QUALITY_BANDS) -> DataFrame:
    """Bands as half-open ratio ranges ``[lo, hi)`` with their ``min_ratio``; the top band has ``hi`` NULL."""
    ordered = sorted(bands, key=lambda b: b[1], reverse=True)
    rows = []
    upper = None
    for name, lower in ordered:
        rows.append((name, float(lower), upper, float(lower)))
        upper = float(lower)
    # the lowest band catches everything below its bound too
    name, _, upper_last, lowest = rows[-1]
    rows[-1] = (name, float("-inf"), upper_last, lowest)
    schema = T.StructType([
        T.StructField("quality_band", T.StringType(), False),
        T.StructField("range_lo", T.DoubleType(), False),
        T.StructField("range_hi", T.DoubleType(), True),
        T.StructField("min_ratio", T.DoubleType(), False),
    ])
    return literal_table(spark, rows, schema)


def band_sql(ratio_sql: str, bands: Sequence[tuple[str, float]] = QUALITY_BANDS) -> str:
    """CASE chain generated from the band rows, so thresholds live in one place."""
    ordered = sorted(bands, key=lambda b: b[1], reverse=True)
    whens = " ".join(f"WHEN {ratio_sql} >= CAST({float(lo)!r} AS DOUBLE) THEN {sql_str(name)}"
                     for name, lo in ordered[:-1])
    last = sql_str(ordered[-1][0])
    return f"CASE {whens} ELSE {last} END" if whens else last


def band_expr(ratio_col: str, bands: Sequence[tuple[str, float]] = QUALITY_BANDS) -> Column:
    return F.expr(band_sql(quote(ratio_col), bands))


def assign_band(df: DataFrame, ratio_col: str = "completeness_ratio",
                bands: Sequence[tuple[str, float]] = QUALITY_BANDS) -> DataFrame:
    return df.withColumn("quality_band", band_expr(ratio_col, bands))


def ingestion_validation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One-pass check: ``total_rows``, ``total_columns``, ``completely_empty_rows``.

    A row is wholly empty when every scored column is missing. Raising on an
    empty input is left to :func:`assert_valid` so this stays lazy.
    """
    cols = list(df.columns if columns is None else columns)
    n = len(cols)
    empty = (missing_count(cols) == F.lit(n)) if n else F.lit(False)
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        F.lit(n).cast("int").alias("total_columns"),
        F.coalesce(F.sum(F.when(empty, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("completely_empty_rows"),
    )


class ValidationError(ValueError):
    pass


def assert_valid(report: DataFrame) -> dict:
    """Collect the one-row validation report and raise on no rows or no columns."""
    row = report.first().asDict()
    if row["total_columns"] == 0:
        raise ValidationError("input has no columns")
    if row["total_rows"] == 0:
        raise ValidationError("input is empty")
    return row
