"""Table profiles computed in one pass per report.

Each profile is one wide aggregation over all columns (Spark does not merge
separate actions, so one job per column would rescan the table per column),
followed by an ``inline`` of an array of per-column structs to get one row per
column. Row order: a unique tie-break is always added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabqual.functions.columns import numeric_columns, qcol, quote, sql_str, string_columns
from tabqual.functions.literals import literal_table
from tabqual.functions.missing import missing_flag_sql, safe_ratio_sql
from tabqual.operators import frequent
from tabqual.operators.ranking import exact_quantiles


def _inline(structs: list[str]) -> str:
    return f"inline(array({', '.join(structs)}))"


# Fixed value: most columns of one wide aggregation. Wider tables are profiled in
# chunks, a scan each; no column is left out, and each scan reads only its own columns.
MAX_COLUMNS_PER_AGG = 200


def chunked(columns: Sequence[str], build) -> DataFrame:
    """``build(chunk)`` for every chunk of at most ``MAX_COLUMNS_PER_AGG`` columns, unioned."""
    cols = list(columns)
    parts = [build(cols[i:i + MAX_COLUMNS_PER_AGG]) for i in range(0, max(len(cols), 1), MAX_COLUMNS_PER_AGG)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summary_totals(df: DataFrame, ratio_col: str | None = "completeness_ratio") -> DataFrame:
    """``total_records`` (+ ``avg_completeness`` when the ratio column exists)."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("total_records")]
    if ratio_col and ratio_col in df.columns:
        aggs.append(F.avg(ratio_col).alias("avg_completeness"))
    return df.agg(*aggs)


def dataset_profile(df: DataFrame, source: str) -> DataFrame:
    """``total_records, total_columns, source_url``."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("total_records")).select(
        "total_records", F.lit(len(df.columns)).alias("total_columns"), F.lit(source).alias("source_url"))


def group_count_desc(df: DataFrame, column: str, count_name: str = "records") -> DataFrame:
    """Rows per value of ``column``, most frequent first (value breaks ties)."""
    return (df.groupBy(qcol(column).alias(column))
              .agg(F.count(F.lit(1)).cast("bigint").alias(count_name))
              .orderBy(F.desc(count_name), F.asc_nulls_first(column)))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, null_count, null_ratio`` where null means NULL or blank; most missing first."""
    cols = list(df.columns if columns is None else columns)

    def build(chunk: Sequence[str]) -> DataFrame:
        aggs = ["count(1) AS total"] + [f"sum({missing_flag_sql(c)}) AS m{i}" for i, c in enumerate(chunk)]
        wide = df.agg(*[F.expr(a) for a in aggs])
        return wide.selectExpr(_inline([
            f"named_struct('column', {sql_str(c)}, 'null_count', CAST(coalesce(m{i}, 0) AS BIGINT), "
            f"'null_ratio', {safe_ratio_sql(f'coalesce(m{i}, 0)', 'total')})" for i, c in enumerate(chunk)]))

    return chunked(cols, build).orderBy(F.desc("null_ratio"), F.asc("column"))


def null_profile_by_group(df: DataFrame, group_cols: Sequence[str],
                          columns: Sequence[str] | None = None) -> DataFrame:
    """Null profile per group: ``<groups>, total_rows, column, null_count, null_ratio``."""
    groups = list(group_cols)
    cols = [c for c in (df.columns if columns is None else columns) if c not in groups]
    aggs = [F.expr("count(1) AS total")] + [F.expr(f"sum({missing_flag_sql(c)}) AS m{i}") for i, c in enumerate(cols)]
    wide = df.groupBy(*[qcol(g).alias(g) for g in groups]).agg(*aggs)
    return wide.selectExpr(*[quote(g) for g in groups], "CAST(total AS BIGINT) AS total_rows", _inline([
        f"named_struct('column', {sql_str(c)}, 'null_count', CAST(m{i} AS BIGINT), "
        f"'null_ratio', {safe_ratio_sql(f'm{i}', 'total')})" for i, c in enumerate(cols)]))


def with_fixed_average(df: DataFrame, by: str = "column", value: str = "null_ratio",
                       out: str = "avg_null_ratio_fixed") -> DataFrame:
    """Level-of-detail average ``{FIXED [by]: AVG([value])}`` kept at row grain.

    A window over the rows of a report (one row per group and column), so the source is planned once.
    """
    return df.withColumn(out, F.avg(value).over(Window.partitionBy(by)))


def null_ratio_filter(profile: DataFrame, columns: Sequence[str] | None = None,
                      threshold: float = 0.0) -> DataFrame:
    """Dashboard filter: chosen columns whose ``null_ratio`` is at least ``threshold``."""
    cond = F.col("null_ratio") >= F.lit(float(threshold))
    if columns is not None:
        cond = cond & F.col("column").isin(list(columns))
    return profile.where(cond)


def column_inventory(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False,
                     rsd: float = 0.05) -> DataFrame:
    """``column, data_type, non_null_count, null_count, fill_rate, distinct_count``.

    NULL here is SQL NULL only (blank strings count as filled). Distinct
    counts are HyperLogLog++ estimates unless ``exact``. Exact ones come from one two-step
    aggregation per column, whose scan reads that column alone (several distinct counts in one
    aggregation would copy every row once per column).
    """
    cols = list(df.columns if columns is None else columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def build(chunk: Sequence[str]) -> DataFrame:
        aggs = ["count(1) AS total"]
        for i, c in enumerate(chunk):
            q = quote(c)
            distinct = "CAST(NULL AS BIGINT)" if exact else f"approx_count_distinct({q}, {rsd!r})"
            aggs += [f"count({q}) AS nn{i}", f"first({distinct}) AS dc{i}" if exact else f"{distinct} AS dc{i}"]
        wide = df.agg(*[F.expr(a) for a in aggs])
        return wide.selectExpr(_inline([
            f"named_struct('column', {sql_str(c)}, 'data_type', {sql_str(types[c])}, "
            f"'non_null_count', CAST(nn{i} AS BIGINT), 'null_count', CAST(total - nn{i} AS BIGINT), "
            f"'fill_rate', {safe_ratio_sql(f'nn{i}', 'total')}, 'distinct_count', CAST(dc{i} AS BIGINT))"
            for i, c in enumerate(chunk)]))

    rows = chunked(cols, build)
    if exact and cols:
        counts = None
        for c in cols:
            own = (df.select(qcol(c).alias("v")).where(F.col("v").isNotNull()).groupBy("v").agg(F.lit(1).alias("one"))
                     .agg(F.count("one").alias("distinct_count")).select(F.lit(c).alias("column"), "distinct_count"))
            counts = own if counts is None else counts.unionByName(own)
        rows = rows.drop("distinct_count").join(counts, "column")
    return rows.orderBy(F.desc("fill_rate"), F.desc("distinct_count"), F.asc("column"))


def numeric_statistics(df: DataFrame, columns: Sequence[str] | None = None,
                       median: str = "exact", accuracy: int = 10_000) -> DataFrame:
    """``column, mean, stddev, min, median, max`` for numeric columns (sample stddev).

    ``median="exact"`` gives the lower median (rank ``ceil(n/2)``) through
    :func:`exact_quantiles`, whose first pass also computes the other
    statistics; ``"approx"`` uses ``percentile_approx`` with ``accuracy``.
    The result has one row per column, built from those few scalars.
    """
    cols = list(numeric_columns(df) if columns is None else columns)
    schema = "column string, mean double, stddev double, min double, median double, max double"
    if not cols:
        return literal_table(df.sparkSession, [], schema)
    stats = []
    for i, c in enumerate(cols):
        q = quote(c)
        stats += [f"CAST(avg({q}) AS DOUBLE) AS mean{i}", f"CAST(stddev_samp({q}) AS DOUBLE) AS sd{i}",
                  f"CAST(min({q}) AS DOUBLE) AS min{i}", f"CAST(max({q}) AS DOUBLE) AS max{i}"]
        if median == "approx":
            stats.append(f"CAST(percentile_approx({q}, 0.5, {int(accuracy)}) AS DOUBLE) AS med{i}")
    if median == "exact":
        meds, row = exact_quantiles(df, cols, 0.5, extra_aggs=[F.expr(e) for e in stats], accuracy=accuracy)
        row = dict(row, **{f"med{i}": (None if meds[c] is None else float(meds[c])) for i, c in enumerate(cols)})
    else:
        row = df.agg(*[F.expr(e) for e in stats]).first().asDict()
    rows = [(c, row[f"mean{i}"], row[f"sd{i}"], row[f"min{i}"], row[f"med{i}"], row[f"max{i}"])
            for i, c in enumerate(cols)]
    return literal_table(df.sparkSession, rows, schema)


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """Top ``k`` non-blank values per string column: ``column, value, count``; ties: smaller value first.

    Exact, by :func:`tabqual.operators.frequent.top_values`: a summary proposes heavy values, an exact recount proves them, and
    columns without heavy values are counted by digest, so whole values are no shuffle keys.
    """
    return frequent.top_values(df, string_columns(df, exclude=("ingested_at",)) if columns is None else columns, k)


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """Report top-k (e.g. five most missing columns, best model)."""
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, key: Sequence[str], n: int = 100) -> DataFrame:
    """Deterministic preview: first ``n`` rows by ``key``."""
    return df.orderBy(*[qcol(c) for c in key]).limit(n)
