"""Named queries over the driver tables, each with its SQL oracle text.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables (or data Spark derives from them). ``ORACLE_SQL`` holds an
independent SQL formulation for DuckDB where one exists; queries whose
result depends on model training have none (rows-only check).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabqual.functions.literals import literal_table
from tabqual.functions.sampling import poisson1_weight_sql
from tabqual.operators import curate as cu
from tabqual.operators import evaluate as ev
from tabqual.operators import features as fe
from tabqual.operators import incremental as inc
from tabqual.operators import observed as ob
from tabqual.operators import profile as pr
from tabqual.operators import quality as qu
from tabqual.operators import sketches as sk
from tabqual.operators import split as sp
from tabqual.operators import stored_join as sj
from tabqual.operators.ranking import exact_quantiles
from tabqual.plans.fixtures import FX1_SQL, FX2_SOURCE_COLUMNS, FX2_SQL, FX3_SQL, fx1, fx2, fx3, table
from tabqual.plans import derived_sources as ds
from tabqual.session import materialize, shared_path, shuffle_partitions
from tabqual.sources import drift
from tabqual.sources import readers as rd
from tabqual.sources import sinks
from tabqual.sources import structural

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

# Fixed run timestamp for curated outputs, so every evaluation agrees.
RUN_TS = dt.datetime(2026, 1, 15, 12, 0, 0)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _missing_sql(c: str) -> str:
    return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"


def _present_sql(c: str) -> str:
    return f"(CASE WHEN {_missing_sql(c)} THEN 0 ELSE 1 END)"


def _band_sql(ratio: str) -> str:
    return (f"CASE WHEN {ratio} >= 0.85 THEN 'HIGH' WHEN {ratio} >= 0.6 THEN 'MEDIUM' ELSE 'LOW' END")


_SRC = FX2_SOURCE_COLUMNS
_ALL_FX2 = ("record_id", "kind", "name", "review", "amount", "event_ts")
_NONEMPTY_SRC = " + ".join(_present_sql(c) for c in _SRC)
_NONEMPTY_ALL = " + ".join(_present_sql(c) for c in _ALL_FX2)
_BANDS_SQL = "SELECT * FROM (VALUES ('HIGH', 0.85::DOUBLE), ('MEDIUM', 0.60::DOUBLE), ('LOW', 0.0::DOUBLE)) t(quality_band, min_ratio)"


def _curated_fx2(spark: SparkSession, sf_dir: str, strategy: str = "broadcast") -> DataFrame:
    src = fx2(spark, sf_dir).select(*_SRC)
    return cu.curate(src, run_ts=RUN_TS, strategy=strategy)


# --------------------------------------------------------------------------- quality

@register("row_completeness", f"""
WITH fx2 AS ({FX2_SQL})
SELECT record_id,
  CAST({_NONEMPTY_ALL} AS INTEGER) AS non_empty_fields,
  CAST({_NONEMPTY_ALL} AS DOUBLE) / 6.0 AS completeness_ratio,
  CAST(length(coalesce(CAST(name AS VARCHAR), '')) AS INTEGER) AS name_length
FROM fx2""")
def q_row_completeness(spark, sf_dir):
    df = fx2(spark, sf_dir)
    out = qu.RowProfileTransformer().transform(df)
    return out.select("record_id", "non_empty_fields", "completeness_ratio", "name_length")


_BAND_DIST_SQL = f"""
WITH fx2 AS ({FX2_SQL}),
scored AS (SELECT CAST({_NONEMPTY_SRC} AS DOUBLE) / 4.0 AS r FROM fx2),
banded AS (SELECT {_band_sql('r')} AS quality_band FROM scored),
dim AS ({_BANDS_SQL})
SELECT b.quality_band, d.min_ratio, CAST(count(*) AS BIGINT) AS records
FROM banded b LEFT JOIN dim d USING (quality_band)
GROUP BY b.quality_band, d.min_ratio"""


def _band_distribution(spark, sf_dir, strategy):
    cur = _curated_fx2(spark, sf_dir, strategy)
    return (cur.groupBy("quality_band", "min_ratio")
               .agg(F.count(F.lit(1)).cast("bigint").alias("records"))
               .orderBy(F.desc("records"), "quality_band"))


@register("quality_band_distribution", _BAND_DIST_SQL)
def q_band_broadcast(spark, sf_dir):
    return _band_distribution(spark, sf_dir, "broadcast")


@register("quality_band_sortmerge", _BAND_DIST_SQL)
def q_band_merge(spark, sf_dir):
    return _band_distribution(spark, sf_dir, "merge")


@register("quality_band_range", _BAND_DIST_SQL)
def q_band_range(spark, sf_dir):
    return _band_distribution(spark, sf_dir, "range")


@register("ingestion_validation", f"""
WITH fx2 AS ({FX2_SQL})
SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(6 AS INTEGER) AS total_columns,
  CAST(coalesce(sum(CASE WHEN {_NONEMPTY_ALL} = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS completely_empty_rows
FROM fx2""")
def q_ingestion_validation(spark, sf_dir):
    return qu.ingestion_validation(fx2(spark, sf_dir))


@register("summary_totals", f"""
WITH fx2 AS ({FX2_SQL})
SELECT CAST(count(*) AS BIGINT) AS total_records,
  round(avg(CAST({_NONEMPTY_SRC} AS DOUBLE) / 4.0), 9) AS avg_completeness
FROM fx2""")
def q_summary_totals(spark, sf_dir):
    out = pr.summary_totals(_curated_fx2(spark, sf_dir))
    return out.select("total_records", F.round("avg_completeness", 9).alias("avg_completeness"))


# --------------------------------------------------------------------------- profiles

def _union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _null_profile_sql(source_sql: str, cols: tuple[str, ...], alias: str = "src") -> str:
    sums = ", ".join(f"sum(CASE WHEN {_missing_sql(c)} THEN 1 ELSE 0 END) AS m{i}" for i, c in enumerate(cols))
    parts = [f"SELECT '{c}' AS \"column\", CAST(coalesce(m{i}, 0) AS BIGINT) AS null_count, "
             f"CASE WHEN n = 0 THEN 0.0 ELSE CAST(coalesce(m{i}, 0) AS DOUBLE) / n END AS null_ratio FROM t"
             for i, c in enumerate(cols)]
    return f"WITH {alias} AS ({source_sql}), t AS (SELECT count(*) AS n, {sums} FROM {alias})\n" + _union_sql(parts)


@register("null_profile", _null_profile_sql(FX2_SQL, _ALL_FX2))
def q_null_profile(spark, sf_dir):
    return pr.null_profile(fx2(spark, sf_dir))


_FILTER_COLS = ("kind", "name", "review", "amount")


@register("null_ratio_filter", f"""
SELECT * FROM ({_null_profile_sql(FX2_SQL, _ALL_FX2)}) p
WHERE "column" IN ({", ".join(f"'{c}'" for c in _FILTER_COLS)}) AND null_ratio >= 0.1""")
def q_null_ratio_filter(spark, sf_dir):
    return pr.null_ratio_filter(pr.null_profile(fx2(spark, sf_dir)), _FILTER_COLS, 0.1)


_FX1_COLS = ("doc_id", "text", "source", "n_chars", "quality", "toxic")


def _grouped_null_sql() -> str:
    sums = ", ".join(f"sum(CASE WHEN {_missing_sql(c)} THEN 1 ELSE 0 END) AS m{i}" for i, c in enumerate(_FX1_COLS))
    parts = [f"SELECT lang, CAST(n AS BIGINT) AS total_rows, '{c}' AS \"column\", CAST(m{i} AS BIGINT) AS null_count, "
             f"CAST(m{i} AS DOUBLE) / n AS null_ratio FROM t" for i, c in enumerate(_FX1_COLS)]
    return (f"WITH fx1 AS ({FX1_SQL}), t AS (SELECT lang, count(*) AS n, {sums} FROM fx1 GROUP BY lang), "
            f"p AS ({_union_sql(parts)})\n"
            "SELECT lang, total_rows, \"column\", null_count, round(null_ratio, 9) AS null_ratio, "
            "round(avg(null_ratio) OVER (PARTITION BY \"column\"), 9) AS avg_null_ratio_fixed FROM p")


@register("null_ratio_fixed", _grouped_null_sql())
def q_null_ratio_fixed(spark, sf_dir):
    prof = pr.null_profile_by_group(fx1(spark, sf_dir), ["lang"], _FX1_COLS)
    out = pr.with_fixed_average(prof, "column", "null_ratio", "avg_null_ratio_fixed")
    return out.withColumns({"null_ratio": F.round("null_ratio", 9),
                            "avg_null_ratio_fixed": F.round("avg_null_ratio_fixed", 9)})


_FX2_TYPES = {"record_id": "bigint", "kind": "string", "name": "string", "review": "string",
              "amount": "double", "event_ts": "timestamp_ntz"}


def _inventory_sql(source_sql: str, types: dict[str, str], exact: bool = True) -> str:
    cols = list(types)
    aggs = ", ".join(f"count({c}) AS nn{i}, count(DISTINCT {c}) AS dc{i}" for i, c in enumerate(cols))
    parts = [f"SELECT '{c}' AS \"column\", '{types[c]}' AS data_type, CAST(nn{i} AS BIGINT) AS non_null_count, "
             f"CAST(n - nn{i} AS BIGINT) AS null_count, CASE WHEN n = 0 THEN 0.0 ELSE CAST(nn{i} AS DOUBLE) / n END AS fill_rate, "
             f"CAST(dc{i} AS BIGINT) AS distinct_count FROM t" for i, c in enumerate(cols)]
    return f"WITH src AS ({source_sql}), t AS (SELECT count(*) AS n, {aggs} FROM src)\n" + _union_sql(parts)


@register("column_inventory_exact", _inventory_sql(FX2_SQL, _FX2_TYPES))
def q_inventory_exact(spark, sf_dir):
    return pr.column_inventory(fx2(spark, sf_dir), exact=True)


_ORDERS_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
                 "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


@register("column_inventory_approx", f"""
SELECT "column", data_type, non_null_count, null_count, fill_rate, true AS distinct_within_rsd
FROM ({_inventory_sql("SELECT * FROM orders", _ORDERS_TYPES)}) x""")
def q_inventory_approx(spark, sf_dir):
    """HLL distinct counts checked against exact ones (3 x rsd tolerance)."""
    orders = table(spark, sf_dir, "orders")
    approx = pr.column_inventory(orders, exact=False, rsd=0.05)
    exact = pr.column_inventory(orders, exact=True).select("column", F.col("distinct_count").alias("exact_dc"))
    joined = approx.join(exact, "column")
    ok = F.abs(F.col("distinct_count") - F.col("exact_dc")) <= F.col("exact_dc") * F.lit(0.15)
    return joined.select("column", "data_type", "non_null_count", "null_count", "fill_rate",
                         ok.alias("distinct_within_rsd"))


_LINEITEM_NUM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax")


@register("numeric_statistics", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in _LINEITEM_NUM))
def q_numeric_statistics(spark, sf_dir):
    stats = pr.numeric_statistics(table(spark, sf_dir, "lineitem"))
    return stats.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


def _doc_store(spark, sf_dir):
    """Documents, and a sketch store that got the largest source last, after the others, and one source twice."""
    docs = table(spark, sf_dir, "documents")
    last = docs.groupBy("source").count().orderBy(F.desc("count"), "source").first()["source"]
    store = shared_path(spark, "document-sketches")
    early = docs.where(~F.col("source").eqNullSafe(F.lit(last)))
    sk.update_store(early, store, "source")
    sk.update_store(docs.where(F.col("source").eqNullSafe(F.lit(last))), store, "source")
    return docs, sk.read_store(spark, store)


_DOC_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "n_chars": "bigint"}


@register("incremental_inventory", _union_sql([
    f"SELECT '{c}' AS \"column\", '{t}' AS data_type, CAST(count({c}) AS BIGINT) AS non_null_count, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
    f"count({c}) / CAST(count(*) AS DOUBLE) AS fill_rate, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_exact, true AS distinct_within FROM documents"
    for c, t in _DOC_TYPES.items()]))
def q_incremental_inventory(spark, sf_dir):
    """Inventory merged from the sketches of ingest partitions, against the exact one of the whole table: counts are equal, and
    distinct counts within four standard deviations of the sketch's error."""
    docs, profile = _doc_store(spark, sf_dir)
    merged = sk.merged_inventory(profile)
    exact = pr.column_inventory(docs.drop("source"), exact=True).select("column", F.col("distinct_count").alias("distinct_exact"))
    off = F.abs(F.col("distinct_count") - F.col("distinct_exact"))
    within = (off <= 4 * sk.HLL_ERROR * F.col("distinct_exact") + 1).alias("distinct_within")
    return merged.join(exact, "column").select("column", "data_type", "non_null_count", "null_count", "fill_rate", "distinct_exact", within)


_DOC_PROBABILITIES = (0.15, 0.5, 0.9)


@register("incremental_quantiles", _union_sql([
    f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS probability, CAST(quantile_disc({c}, {p}) AS BIGINT) AS value, true AS bracketed FROM documents"
    for c in ("doc_id", "n_chars") for p in _DOC_PROBABILITIES]))
def q_incremental_quantiles(spark, sf_dir):
    """Exact quantiles whose brackets come from the stored quantile sketches of ingest partitions, with no sketching scan."""
    docs, profile = _doc_store(spark, sf_dir)
    bounds = {(r["column"], r["probability"]): (r["low_bound"], r["high_bound"])
              for r in sk.merged_quantiles(profile, _DOC_PROBABILITIES).collect()}  # a row for each column and probability
    rows = []
    for p in _DOC_PROBABILITIES:
        values, _ = exact_quantiles(docs, ["doc_id", "n_chars"], p, bounds={c: b for (c, q), b in bounds.items() if q == p})
        rows += [(c, p, v, v is not None and bounds[c, p][0] <= v <= bounds[c, p][1]) for c, v in values.items()]
    return literal_table(spark, rows, "column string, probability double, value bigint, bracketed boolean")


_HOLED_DOCS = ("doc_id", "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE lang END AS lang", "CASE WHEN doc_id % 5 = 0 THEN '  ' ELSE source END AS source",
               "CASE WHEN doc_id % 11 < 4 THEN NULL ELSE n_chars END AS n_chars", "text")
_HOLED = ("doc_id", "lang", "source", "n_chars", "text")


@register("observed_curation", f"""
WITH h AS (SELECT {", ".join(_HOLED_DOCS)} FROM documents),
s AS (SELECT *, CAST({" + ".join(_present_sql(c) for c in _HOLED)} AS DOUBLE) / 5.0 AS r FROM h)
SELECT 'rows' AS metric, '' AS name, CAST(count(*) AS DOUBLE) AS value FROM s
UNION ALL SELECT 'empty_rows', '', CAST(count_if(r = 0) AS DOUBLE) FROM s
UNION ALL SELECT 'avg_completeness', '', round(avg(r), 9) FROM s
UNION ALL SELECT 'band', {_band_sql('r')}, CAST(count(*) AS DOUBLE) FROM s GROUP BY 2
UNION ALL {" UNION ALL ".join(f"SELECT 'missing', '{c}', CAST(count_if({_missing_sql(c)}) AS DOUBLE) FROM s" for c in _HOLED)}""")
def q_observed_curation(spark, sf_dir):
    """Validation, totals, bands and missing values of a curated table, observed by the job that writes it."""
    source = table(spark, sf_dir, "documents").selectExpr(*_HOLED_DOCS)
    curated = cu.layout_for_write(cu.curate(source, run_ts=RUN_TS, with_name_length=False))
    path = shared_path(spark, "observed")
    seen = ob.write_observed(curated, lambda df: sinks.write_partitioned_parquet(df, path, layout=None), _HOLED)
    named = lambda metric, df, name, value: df.select(
        F.lit(metric).alias("metric"), name.alias("name"), value.cast("double").alias("value"))
    parts = [named("rows", seen.validation(), F.lit(""), F.col("total_rows")),
             named("empty_rows", seen.validation(), F.lit(""), F.col("completely_empty_rows")),
             named("avg_completeness", seen.totals(), F.lit(""), F.round("avg_completeness", 9)),
             named("band", seen.band_distribution(), F.col("quality_band"), F.col("records")),
             named("missing", seen.null_profile().where(F.col("column").isin(*_HOLED)), F.col("column"), F.col("null_count"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_DOC_STRINGS = ("text", "lang", "source")


@register("top_values", f"""
WITH long AS ({_union_sql([f"SELECT '{c}' AS \"column\", {c} AS value FROM documents" for c in _DOC_STRINGS])}),
counted AS (SELECT "column", value, CAST(count(*) AS BIGINT) AS count FROM long
            WHERE NOT {_missing_sql('value')} GROUP BY "column", value),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value ASC) AS rn FROM counted)
SELECT "column", value, count FROM ranked WHERE rn <= 5""")
def q_top_values(spark, sf_dir):
    return pr.top_values(table(spark, sf_dir, "documents"))


@register("group_count_desc", """
SELECT event_type, CAST(count(*) AS BIGINT) AS records FROM events GROUP BY event_type""")
def q_group_count_desc(spark, sf_dir):
    return pr.group_count_desc(table(spark, sf_dir, "events"), "event_type")


@register("profile_top_k", f"""
SELECT * FROM ({_null_profile_sql(FX2_SQL, _ALL_FX2)}) p ORDER BY null_ratio DESC, "column" LIMIT 5""")
def q_profile_top_k(spark, sf_dir):
    prof = pr.null_profile(fx2(spark, sf_dir))
    return pr.top_k(prof, [F.desc("null_ratio"), F.asc("column")], 5)


@register("sample_export", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 500")
def q_sample_export(spark, sf_dir):
    return pr.preview(table(spark, sf_dir, "orders"), ["o_orderkey"], 500)


@register("dataset_profile", f"""
WITH fx2 AS ({FX2_SQL})
SELECT CAST(count(*) AS BIGINT) AS total_records, CAST(6 AS INTEGER) AS total_columns,
  'orders' AS source_url FROM fx2""")
def q_dataset_profile(spark, sf_dir):
    return pr.dataset_profile(fx2(spark, sf_dir), "orders")


# --------------------------------------------------------------------------- curation layout

@register("scaling_query", f"""
WITH fx2 AS ({FX2_SQL})
SELECT CAST(year(event_ts) AS INTEGER) AS ingest_year, CAST(count(*) AS BIGINT) AS rows,
  round(avg(CAST({_NONEMPTY_SRC} AS DOUBLE) / 4.0), 9) AS avg_comp
FROM fx2 GROUP BY 1""")
def q_scaling_query(spark, sf_dir):
    cur = cu.curate(fx2(spark, sf_dir), columns=_SRC, time_col="event_ts")
    return cur.groupBy("ingest_year").agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                          F.round(F.avg("completeness_ratio"), 9).alias("avg_comp"))


@register("curated_partition_roundtrip", f"""
WITH fx2 AS ({FX2_SQL}), r AS (SELECT event_ts, CAST({_NONEMPTY_SRC} AS DOUBLE) / 4.0 AS ratio FROM fx2)
SELECT CAST(year(event_ts) AS INTEGER) AS ingest_year, CAST(month(event_ts) AS INTEGER) AS ingest_month,
  CAST(count(*) AS BIGINT) AS rows, round(avg(ratio), 9) AS avg_completeness,
  CAST(sum(CASE WHEN {_band_sql('ratio')} = 'LOW' THEN 1 ELSE 0 END) AS BIGINT) AS low_rows
FROM r GROUP BY 1, 2""")
def q_curated_roundtrip(spark, sf_dir):
    """Curate, write partitioned by event year/month, read back with partition discovery."""
    cur = cu.curate(fx2(spark, sf_dir), columns=_SRC, time_col="event_ts")
    path = shared_path(spark, "curated")
    sinks.write_partitioned_parquet(cur, path, ("ingest_year", "ingest_month"))
    back = spark.read.parquet(path)
    return back.groupBy("ingest_year", "ingest_month").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.round(F.avg("completeness_ratio"), 9).alias("avg_completeness"),
        F.sum(F.when(F.col("quality_band") == "LOW", 1).otherwise(0)).cast("bigint").alias("low_rows"))


# --------------------------------------------------------------------------- split, label, features

_SPLIT_SQL = """
SELECT o_orderkey, o_orderstatus AS label,
  CASE WHEN pr <= 0.7 THEN 'train' WHEN pr <= 0.85 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT o_orderkey, o_orderstatus,
        percent_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS pr FROM orders) x"""


def _orders_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("label"))
    return sp.stratified_split(o, "label", ["o_orderdate", "o_orderkey"])


@register("stratified_split", _SPLIT_SQL)
def q_stratified_split(spark, sf_dir):
    return _orders_split(spark, sf_dir).select("o_orderkey", "label", "split")


@register("split_class_distribution", f"""
WITH s AS ({_SPLIT_SQL}), c AS (SELECT split, label, CAST(count(*) AS BIGINT) AS count FROM s GROUP BY 1, 2)
SELECT split, label, count, round(CAST(count AS DOUBLE) / sum(count) OVER (PARTITION BY split), 9) AS ratio FROM c""")
def q_split_distribution(spark, sf_dir):
    dist = sp.split_class_distribution(_orders_split(spark, sf_dir), "label")
    return dist.withColumn("ratio", F.round("ratio", 9))


@register("label_builder", f"""
WITH fx2 AS ({FX2_SQL}),
r AS (SELECT record_id, CAST({_present_sql('kind')} AS DOUBLE) / 1.0 AS label_basis_ratio FROM fx2),
t AS (SELECT quantile_disc(label_basis_ratio, 0.15) AS thr FROM r)
SELECT record_id, label_basis_ratio,
  CASE WHEN label_basis_ratio <= thr THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label
FROM r, t""")
def q_label_builder(spark, sf_dir):
    src = fx2(spark, sf_dir).select(*_SRC)
    labeled, _ = fe.build_label(src, keep_ratio=True)
    return labeled.select("record_id", "label_basis_ratio", "label")


_GUARD_CANDIDATES = ("name", "review", "amount", "event_ts")
_GUARD_UNION = _union_sql([f"SELECT '{c}' AS \"column\", r{i} AS missing_ratio FROM r"
                           for i, c in enumerate(_GUARD_CANDIDATES)])


@register("feature_missing_guard", f"""
WITH fx2 AS ({FX2_SQL}),
r AS (SELECT {", ".join(f"avg(CASE WHEN {_missing_sql(c)} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS r{i}" for i, c in enumerate(_GUARD_CANDIDATES))} FROM fx2),
u AS ({_GUARD_UNION}),
s AS (SELECT max(CASE WHEN missing_ratio <= 0.1 THEN 1 ELSE 0 END) AS any_strict FROM u)
SELECT "column", round(missing_ratio, 9) AS missing_ratio,
  CASE WHEN any_strict = 1 THEN missing_ratio <= 0.1 ELSE missing_ratio <= 0.3 END AS kept
FROM u, s""")
def q_feature_missing_guard(spark, sf_dir):
    df = fx2(spark, sf_dir)
    basis = fe.label_basis_columns(_SRC)
    candidates = fe.feature_candidates(df.columns, basis)
    guard = fe.missing_guard(fe.missing_ratios(df, candidates))
    return guard.withColumn("missing_ratio", F.round("missing_ratio", 9))


# --------------------------------------------------------------------------- evaluation

@register("confusion_profit", f"""
WITH p AS ({FX3_SQL}), c AS (SELECT
  sum(CASE WHEN score >= 0.5 AND label = 1 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN score >= 0.5 AND label = 0 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN score < 0.5 AND label = 1 THEN 1 ELSE 0 END) AS fn,
  sum(CASE WHEN score < 0.5 AND label = 0 THEN 1 ELSE 0 END) AS tn, count(*) AS n FROM p)
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
  CAST(n AS BIGINT) AS rows, CAST(tp * 600 - fp * 120 - fn * 350 AS DOUBLE) AS expected_profit FROM c""")
def q_confusion_profit(spark, sf_dir):
    return ev.confusion_profit(fx3(spark, sf_dir))


def _pairwise_auc_sql(src: str, group: str | None = None) -> str:
    """Brute-force ROC-AUC: every (positive, negative) pair, ties count one half."""
    g_sel = f"{group}, " if group else ""
    g_join = f"AND a.{group} = b.{group}" if group else ""
    g_by = f"GROUP BY a.{group}" if group else ""
    g_out = f"a.{group} AS {group}, " if group else ""
    return (f"SELECT {g_out}sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) "
            f"/ (count(*)) AS roc_auc FROM (SELECT {g_sel}score FROM {src} WHERE label = 1) a "
            f"JOIN (SELECT {g_sel}score FROM {src} WHERE label = 0) b ON TRUE {g_join} {g_by}")


@register("auc_ranksum", f"""
WITH p AS ({FX3_SQL}),
a AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM p GROUP BY score),
pts AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM a),
cur AS (SELECT score, CAST(tp AS DOUBLE) / (SELECT sum(pos) FROM a) AS recall,
          CAST(tp AS DOUBLE) / (tp + fp) AS prec FROM pts),
seq AS (SELECT recall, prec, lag(recall, 1, 0.0) OVER (ORDER BY score DESC) AS r0,
          coalesce(lag(prec) OVER (ORDER BY score DESC), prec) AS p0 FROM cur),
roc AS ({_pairwise_auc_sql('p')})
SELECT round((SELECT roc_auc FROM roc), 9) AS roc_auc,
  round((SELECT sum((recall - r0) * (prec + p0) / 2.0) FROM seq), 9) AS pr_auc,
  (SELECT CAST(sum(label) AS BIGINT) FROM p) AS positives,
  (SELECT CAST(sum(1 - label) AS BIGINT) FROM p) AS negatives""")
def q_auc_ranksum(spark, sf_dir):
    m = ev.auc_metrics(fx3(spark, sf_dir))
    return m.select(F.round("roc_auc", 9).alias("roc_auc"), F.round("pr_auc", 9).alias("pr_auc"),
                    F.col("positives").cast("bigint").alias("positives"),
                    F.col("negatives").cast("bigint").alias("negatives"))


_U_SQL = ("CAST(('0x' || substr(md5(concat_ws(':', '7', CAST(rep AS VARCHAR), CAST(doc_id AS VARCHAR))), 1, 8)) AS BIGINT)"
          " / 4294967296.0")


@register("auc_bootstrap_ci", f"""
WITH p AS ({FX3_SQL}),
reps AS (SELECT p.doc_id, p.label, p.score, r.range AS rep FROM p, range(0, 200) r),
w AS (SELECT rep, label, score, {poisson1_weight_sql('u')} AS w FROM (SELECT *, {_U_SQL} AS u FROM reps) x),
pos AS (SELECT rep, score, w FROM w WHERE label = 1 AND w > 0),
neg AS (SELECT rep, score, w FROM w WHERE label = 0 AND w > 0),
auc AS (SELECT a.rep, sum(a.w * b.w * CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END)
               / (sum(a.w * b.w)) AS auc
        FROM pos a JOIN neg b ON a.rep = b.rep GROUP BY a.rep)
SELECT round(coalesce(quantile_cont(auc, 0.025), 0.0), 9) AS auc_ci_low,
       round(coalesce(quantile_cont(auc, 0.975), 0.0), 9) AS auc_ci_high,
       CAST(count(*) AS BIGINT) AS replicates_used FROM auc""")
def q_auc_bootstrap_ci(spark, sf_dir):
    ci = ev.bootstrap_auc_ci(fx3(spark, sf_dir), id_col="doc_id", seed=7)
    return ci.select(F.round("auc_ci_low", 9).alias("auc_ci_low"), F.round("auc_ci_high", 9).alias("auc_ci_high"),
                     "replicates_used")


@register("class_weights", """
WITH c AS (SELECT quality, CAST(count(*) AS BIGINT) AS n_class FROM labels GROUP BY quality)
SELECT quality, n_class, round(CAST(sum(n_class) OVER () AS DOUBLE) / (count(*) OVER () * n_class), 9) AS weight FROM c""")
def q_class_weights(spark, sf_dir):
    w = ev.class_weights(table(spark, sf_dir, "labels"), "quality")
    return w.withColumn("weight", F.round("weight", 9))


def _scored_models(spark, sf_dir):
    base = fx3(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = base.join(docs, "doc_id").select(
        "doc_id", "lang", "source", "label", F.size(F.split("text", " ")).cast("double").alias("score"),
        F.lit("word_count").alias("model"))
    chars = base.select("doc_id", "lang", "source", "label", "score", F.lit("char_length").alias("model"))
    return chars.unionByName(words)


_SCORED_MODELS_SQL = f"""
SELECT doc_id, lang, source, label, score, 'char_length' AS model FROM ({FX3_SQL}) f
UNION ALL
SELECT f.doc_id, f.lang, f.source, f.label, CAST(len(string_split(d.text, ' ')) AS DOUBLE) AS score, 'word_count' AS model
FROM ({FX3_SQL}) f JOIN documents d USING (doc_id)"""


def _group_auc_sql(group: str) -> str:
    return (f"SELECT a.model, a.{group}, CASE WHEN count(*) = 0 THEN NULL ELSE sum(CASE WHEN a.score > b.score THEN 1.0 "
            f"WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) / count(*) END AS test_roc_auc "
            f"FROM (SELECT * FROM m WHERE label = 1) a JOIN (SELECT * FROM m WHERE label = 0) b "
            f"ON a.model = b.model AND a.{group} = b.{group} GROUP BY a.model, a.{group}")


@register("model_score_mart", f"""
WITH m AS ({_SCORED_MODELS_SQL}),
u AS (SELECT model, test_roc_auc FROM ({_group_auc_sql('lang')}) x
      UNION ALL SELECT model, test_roc_auc FROM ({_group_auc_sql('source')}) y)
SELECT model, round(avg(test_roc_auc), 9) AS avg_test_roc_auc FROM u WHERE model IS NOT NULL GROUP BY model""")
def q_model_score_mart(spark, sf_dir):
    """Average test AUC per scorer over two metric tables (per language, per source)."""
    # both metric tables read the scored rows: compute them once
    scored = materialize(_scored_models(spark, sf_dir))
    by_lang = ev.auc_metrics(scored, group_cols=["model", "lang"]).select("model", F.col("roc_auc").alias("test_roc_auc"))
    by_src = ev.auc_metrics(scored, group_cols=["model", "source"]).select("model", F.col("roc_auc").alias("test_roc_auc"))
    mart = ev.model_score_mart(by_lang, by_src)
    return mart.withColumn("avg_test_roc_auc", F.round("avg_test_roc_auc", 9))


# --------------------------------------------------------------------------- sources

_ORDERS_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _restore_types(df: DataFrame, like: DataFrame) -> DataFrame:
    """Cast read-back columns to the original table's types, in its column order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


@register("csv_roundtrip", "SELECT * FROM orders")
def q_csv_roundtrip(spark, sf_dir):
    """Orders written as CSV with a header, read back with inferred types."""
    orders = table(spark, sf_dir, "orders")
    back = rd.read_csv(spark, ds.write_csv_copy(spark, orders, "orders-csv"))
    return _restore_types(back, orders)


@register("json_lines_roundtrip", "SELECT * FROM events")
def q_json_roundtrip(spark, sf_dir):
    """Events written as JSON lines, read back with an inferred schema."""
    events = table(spark, sf_dir, "events")
    back = rd.read_json_lines(spark, ds.write_json_copy(spark, events, "events-json"))
    return _restore_types(back, events)


@register("geojson_flatten", """
SELECT event_id, user_id, event_type, value,
  CASE WHEN event_type = 'error' THEN NULL ELSE 'Point' END AS geometry_type FROM events""")
def q_geojson_flatten(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    flat = rd.read_geojson(spark, ds.write_geojson_lines(spark, events), multiline=False)
    return flat.select("event_id", "user_id", "event_type", "value", "geometry_type")


@register("geometry_distribution", """
SELECT CASE WHEN event_type = 'error' THEN NULL ELSE 'Point' END AS geometry_type,
  CAST(count(*) AS BIGINT) AS records FROM events GROUP BY 1""")
def q_geometry_distribution(spark, sf_dir):
    """Rows per geometry type of the flattened GeoJSON features."""
    events = table(spark, sf_dir, "events")
    flat = rd.read_geojson(spark, ds.write_geojson_lines(spark, events), multiline=False)
    return pr.group_count_desc(flat, "geometry_type")


@register("json_unwrap", "SELECT event_id, user_id, event_type, value FROM events")
def q_json_unwrap(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = rd.read_wrapped_json(spark, ds.write_results_lines(spark, events), multiline=False)
    return rows.select("event_id", "user_id", "event_type", "value")


@register("corrupt_split", f"""
SELECT CASE WHEN event_id % {ds.DAMAGE_EVERY} = 0 THEN 'quarantine' ELSE 'good' END AS status,
  CAST(count(*) AS BIGINT) AS rows FROM events GROUP BY 1""")
def q_corrupt_split(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = ds.write_damaged_json_lines(spark, events)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    status = F.when(F.col(rd.CORRUPT_COLUMN).isNull(), "good").otherwise("quarantine").alias("status")
    return rd.parse_lines(spark, path, schema).groupBy(status).agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


_LINE_KINDS = """CASE WHEN event_id % 97 = 0 THEN 'damaged' WHEN event_id % 89 = 0 THEN 'blank'
  WHEN event_id % 83 = 0 THEN 'no struct' ELSE 'good' END"""


@register("corrupt_split_kinds", f"""
SELECT CASE WHEN kind = 'good' THEN 'good' ELSE 'quarantine' END AS status, CAST(count(*) AS BIGINT) AS rows,
  CAST(sum(CASE WHEN kind = 'good' THEN event_id ELSE 0 END) AS BIGINT) AS id_sum
FROM (SELECT event_id, {_LINE_KINDS} AS kind FROM events) e WHERE kind <> 'blank' GROUP BY 1""")
def q_corrupt_split_kinds(spark, sf_dir):
    """Lines that are cut off, blank, or no JSON object at all, beside good ones."""
    events = table(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_id", "event_type"))
    kind = F.expr(_LINE_KINDS)
    text = (F.when(kind == "damaged", F.expr("substring(line, 1, length(line) - 1)")).when(kind == "blank", "  ")
            .when(kind == "no struct", "not json").otherwise(F.col("line")))
    path = shared_path(spark, "events-kinds")
    events.withColumn("line", line).select(text.alias("value")).write.text(path)
    rows = rd.parse_lines(spark, path, T.StructType([T.StructField("event_id", T.LongType()),
                                                     T.StructField("event_type", T.StringType())]))
    status = F.when(F.col(rd.CORRUPT_COLUMN).isNull(), "good").otherwise("quarantine").alias("status")
    good = F.when(F.col(rd.CORRUPT_COLUMN).isNull(), F.col("event_id")).otherwise(0)
    return rows.groupBy(status).agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum(good).alias("id_sum"))


@register("geojson_mixed_lines", """
SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE 'Point' END AS geometry_type FROM events""")
def q_geojson_mixed(spark, sf_dir):
    """Lines that hold a collection, beside lines that are a single Feature."""
    events = table(spark, sf_dir, "events")
    path = shared_path(spark, "events-mixed")
    single = events.where("event_id % 5 = 0").select(F.to_json(ds.event_feature()).alias("value"))
    ds.feature_collections(events.where("event_id % 5 <> 0")).unionByName(single).write.text(path)
    return rd.read_geojson(spark, path, multiline=False).select("event_id", "event_type", "geometry_type")


@register("geojson_documents", """
SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE 'Point' END AS geometry_type FROM events""")
def q_geojson_documents(spark, sf_dir):
    """Files that each hold one pretty-printed collection, over many lines."""
    events = table(spark, sf_dir, "events")
    path = ds.write_documents(spark, ds.feature_collections(events), "events-geojson-documents")
    return rd.read_geojson(spark, path, multiline=True).select("event_id", "event_type", "geometry_type")


@register("json_documents", "SELECT event_id, user_id, event_type, value FROM events")
def q_json_documents(spark, sf_dir):
    """Files that each hold one top-level array, beside files that hold one wrapped array."""
    events = table(spark, sf_dir, "events")
    item = F.struct("event_id", "user_id", "event_type", "value")
    path = ds.write_documents(spark, ds.arrays(events, item), "events-json-documents")
    return rd.read_wrapped_json(spark, path, multiline=True).select("event_id", "user_id", "event_type", "value")


_LANDED_SQL = ds.LANDED_LINE.replace("AS STRING", "AS VARCHAR")
# bounds small enough that files of the driver's small tables go beyond them
_SNIFF_HEAD, _SNIFF_RANGE = 2048, 4096


@register("detected_files", f"""
WITH l AS (SELECT page_id % 6 AS kind, page_id // {ds.ROWS_PER_LANDED_FILE} AS bucket, {_LANDED_SQL} AS line FROM pages),
f AS (SELECT kind, bucket, CAST(sum(strlen(line) + 1) AS BIGINT) AS length, bool_or(contains(line, 'FeatureCollection')) AS marked
      FROM l GROUP BY kind, bucket)
SELECT kind, bucket, length, CAST(CASE WHEN kind = 4 OR length <= {_SNIFF_HEAD} THEN least(length, {_SNIFF_HEAD})
         ELSE length + {len(b"FeatureCollection") - 1} * ceil((length - {_SNIFF_HEAD}) / {_SNIFF_RANGE}.0) END AS BIGINT) AS bytes_read,
  CASE WHEN kind = 0 THEN 'csv' WHEN kind = 5 THEN 'unknown' WHEN kind IN (3, 4) AND marked THEN 'geojson' ELSE 'json' END AS format,
  CASE WHEN kind = 1 THEN 'lines' WHEN kind = 2 OR kind = 3 AND NOT marked THEN 'document' END AS json_layout
FROM f""")
def q_detected_files(spark, sf_dir):
    """Files of six kinds in a landing folder: their formats, and how much of each was read to tell."""
    path = ds.write_landing_folder(spark, table(spark, sf_dir, "pages"))
    files = rd.detect_formats(spark, path, head_bytes=_SNIFF_HEAD, range_bytes=_SNIFF_RANGE)
    part = [F.regexp_extract("path", f"{k}=([0-9]+)", 1).cast("bigint").alias(k) for k in ("kind", "bucket")]
    return files.select(*part, "length", "bytes_read", "format", "json_layout")


# ranges small enough that one document of the driver's small tables is cut into many
_DOCUMENT_RANGE = 1 << 16


@register("geojson_one_document", """
SELECT page_id, url, CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 2 = 0 THEN 'Point' ELSE 'Polygon' END AS geometry_type FROM pages""")
def q_geojson_one_document(spark, sf_dir):
    """One file that holds all pages as one collection, read by many tasks."""
    pages = table(spark, sf_dir, "pages")
    kind = F.when(F.col("page_id") % 7 == 0, None).otherwise(
        F.struct(F.when(F.col("page_id") % 2 == 0, "Point").otherwise("Polygon").alias("type"), F.array("page_id").alias("coordinates")))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("page_id", "url").alias("properties"), kind.alias("geometry"))
    path = ds.write_one_document(spark, pages, "page_id", feature, '{"type": "FeatureCollection",\n "features": [', "]}", "pages-one-collection")
    return structural.read_large_geojson(spark, path, range_bytes=_DOCUMENT_RANGE).select("page_id", "url", "geometry_type")


@register("json_one_document", "SELECT page_id, url, html FROM pages")
def q_json_one_document(spark, sf_dir):
    """One file that holds all pages, whole texts, under one wrapper, beside other arrays; read by many tasks."""
    pages = table(spark, sf_dir, "pages")
    path = ds.write_one_document(spark, pages, "page_id", F.struct("page_id", "url", "html"),
                                 '{"meta": [{"results": [{"page_id": -1}]}],\n "results": [', '], "more": [{"page_id": -2}]}', "pages-one-document")
    return structural.read_large_json(spark, path, range_bytes=_DOCUMENT_RANGE).select("page_id", "url", "html")


@register("format_detect", """
WITH s AS (SELECT page_id, lower(url) AS name, regexp_replace(html, '^\\s+', '') AS sample FROM pages),
f AS (SELECT page_id, name, sample, regexp_extract(sample, '^([^\\r\\n]*)', 1) AS first_line FROM s)
SELECT page_id, CASE
  WHEN html_len = 0 THEN 'empty'
  WHEN name LIKE '%.csv' THEN 'csv'
  WHEN name LIKE '%.geojson' OR (contains(sample, 'FeatureCollection') AND contains(sample, '"type"')) THEN 'geojson'
  WHEN name LIKE '%.json' THEN 'json'
  WHEN contains(first_line, ',') AND NOT (starts_with(first_line, '{') OR starts_with(first_line, '[')) THEN 'csv'
  WHEN starts_with(first_line, '{') OR starts_with(first_line, '[') THEN 'json' ELSE 'unknown' END AS format
FROM f JOIN (SELECT page_id, strlen(html) AS html_len FROM pages) l USING (page_id)""")
def q_format_detect(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", rd.format_expr(F.col("url"), F.col("html"), text=True).alias("format"))


_HOST_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


@register("resource_rank", f"""
WITH c AS (SELECT regexp_extract(url, '{_HOST_RE}', 1) AS dataset, url, page_id AS ordinal,
  CASE WHEN lower(url) LIKE '%.csv' THEN 0 WHEN contains(lower(url), 'geojson') THEN 1
       WHEN lower(url) LIKE '%.json' THEN 2 ELSE 9 END AS rank FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY rank, ordinal) AS rn FROM c)
SELECT dataset, url, CAST(rank AS INTEGER) AS rank, ordinal FROM r WHERE rn = 1""")
def q_resource_rank(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    catalog_df = pages.select(F.regexp_extract("url", _HOST_RE, 1).alias("dataset"),
                              F.lit(None).cast("string").alias("format"), "url",
                              F.col("page_id").alias("ordinal"))
    return rd.best_resource(catalog_df)


_FORMAT_CASES = """CASE page_id % 7 WHEN 0 THEN 'id,v' || chr(10) || '1,a' WHEN 1 THEN '  {"id": 1}' WHEN 2 THEN '[{"id": 1}]'
  WHEN 3 THEN '{"pad": "' || repeat('x', 5000) || '", "type": "FeatureCollection", "features": []}'
  WHEN 4 THEN '' WHEN 5 THEN 'plain words' ELSE html END"""
_NAME_CASES = """CASE page_id % 11 WHEN 0 THEN 'a.csv' WHEN 1 THEN 'a.geojson' WHEN 2 THEN 'a.JSON' ELSE url END"""


@register("format_detect_kinds", f"""
WITH s AS (SELECT page_id, lower({_NAME_CASES}) AS name, {_FORMAT_CASES} AS content FROM pages),
f AS (SELECT *, ltrim(content, ' ' || chr(10)) AS sample FROM s),
g AS (SELECT *, split_part(sample, chr(10), 1) AS first_line FROM f)
SELECT page_id, CASE WHEN content = '' THEN 'empty' WHEN name LIKE '%.csv' THEN 'csv'
  WHEN name LIKE '%.geojson' OR (contains(sample, 'FeatureCollection') AND contains(sample, '"type"')) THEN 'geojson'
  WHEN name LIKE '%.json' THEN 'json'
  WHEN sample[1] IN ('{{', '[') THEN 'json'
  WHEN contains(first_line, ',') THEN 'csv' ELSE 'unknown' END AS format FROM g""")
def q_format_detect_kinds(spark, sf_dir):
    """Every branch of the format decision, a marker after 5,000 characters included."""
    rows = table(spark, sf_dir, "pages").selectExpr("page_id", f"{_NAME_CASES} AS name", f"{_FORMAT_CASES} AS content")
    return rows.select("page_id", rd.format_expr(F.col("name"), F.col("content"), text=True).alias("format"))


_RESOURCE_CASES = "CASE page_id % 5 WHEN 0 THEN 'GeoJSON' WHEN 1 THEN 'JSON' WHEN 2 THEN 'CSV' WHEN 3 THEN '' END"


@register("resource_rank_kinds", f"""
WITH c AS (SELECT page_id % 40 AS dataset, url, page_id AS ordinal, lower(coalesce({_RESOURCE_CASES}, '')) AS f FROM pages
           WHERE page_id % 40 <> page_id % 5 OR page_id % 40 > 2),
k AS (SELECT *, CASE WHEN contains(f, 'csv') OR lower(url) LIKE '%.csv' THEN 0
                     WHEN contains(f, 'geojson') OR contains(lower(url), 'geojson') THEN 1
                     WHEN contains(f, 'json') OR lower(url) LIKE '%.json' THEN 2 ELSE 9 END AS rank FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY rank, ordinal) AS rn FROM k)
SELECT dataset, url, CAST(rank AS INTEGER) AS rank, ordinal FROM r WHERE rn = 1""")
def q_resource_rank_kinds(spark, sf_dir):
    """Resources whose listed formats give every rank."""
    rows = table(spark, sf_dir, "pages").where("page_id % 40 <> page_id % 5 OR page_id % 40 > 2").selectExpr(
        "page_id % 40 AS dataset", f"{_RESOURCE_CASES} AS format", "url", "page_id AS ordinal")
    return rd.best_resource(rows)


_HOLES = ("CASE WHEN o_orderkey % 17 = 0 THEN CAST(NULL AS BIGINT) ELSE o_orderkey END AS a",
          "CASE WHEN o_orderkey % 17 = 0 THEN '  ' WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus END AS b",
          "CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 4 = 0 THEN CAST(NULL AS DOUBLE) ELSE o_totalprice END AS c",
          "CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 3 = 0 THEN CAST(NULL AS STRING) ELSE o_orderpriority END AS d",
          "CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END AS e")
_HOLES_SQL = "SELECT o_orderkey, " + ", ".join(_HOLES).replace("AS STRING", "AS VARCHAR") + " FROM orders"


def _holes(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", *_HOLES)


@register("ingestion_validation_empty_rows", f"""
SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(5 AS INTEGER) AS total_columns,
  CAST(sum(CASE WHEN {" AND ".join(_missing_sql(c) for c in "abcde")} THEN 1 ELSE 0 END) AS BIGINT) AS completely_empty_rows
FROM ({_HOLES_SQL}) h""")
def q_validation_empty_rows(spark, sf_dir):
    """Rows in which every column is NULL or blank."""
    return qu.ingestion_validation(_holes(spark, sf_dir).drop("o_orderkey"))


@register("feature_missing_guard_relaxed", f"""
WITH h AS ({_HOLES_SQL}),
u AS ({_union_sql([f"SELECT '{c}' AS column_name, avg(CASE WHEN {_missing_sql(c)} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS r FROM h" for c in "bcde"])})
SELECT column_name AS "column", round(r, 9) AS missing_ratio, r <= 0.3 AS kept FROM u""")
def q_guard_relaxed(spark, sf_dir):
    """No column passes the strict level, so the relaxed one decides."""
    guard = fe.missing_guard(fe.missing_ratios(_holes(spark, sf_dir), list("bcde")))
    return guard.withColumn("missing_ratio", F.round("missing_ratio", 9))


@register("label_builder_wide", f"""
WITH r AS (SELECT o_orderkey, ({_present_sql('a')} + {_present_sql('b')}) / CAST(2 AS DOUBLE) AS label_basis_ratio FROM ({_HOLES_SQL}) h),
t AS (SELECT quantile_disc(label_basis_ratio, 0.15) AS thr FROM r)
SELECT o_orderkey, label_basis_ratio, CASE WHEN label_basis_ratio <= thr THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label
FROM r, t""")
def q_label_builder_wide(spark, sf_dir):
    """Two basis columns out of five candidates."""
    return fe.build_label(_holes(spark, sf_dir), exclude=("o_orderkey",), keep_ratio=True)[0].select(
        "o_orderkey", "label_basis_ratio", "label")


@register("unknown_fill", f"""
SELECT o_orderkey, coalesce(b, 'UNKNOWN') AS b, coalesce(d, 'UNKNOWN') AS d FROM ({_HOLES_SQL}) h""")
def q_unknown_fill(spark, sf_dir):
    return _holes(spark, sf_dir).na.fill(fe.UNKNOWN, subset=["b", "d"]).select("o_orderkey", "b", "d")


@register("report_csv_roundtrip", "SELECT event_type, CAST(count(*) AS BIGINT) AS records FROM events GROUP BY event_type")
def q_report_csv(spark, sf_dir):
    """A report written as CSV and read back."""
    path = shared_path(spark, "report")
    sinks.write_report_csv(pr.group_count_desc(table(spark, sf_dir, "events"), "event_type"), path)
    return rd.read_csv(spark, path, schema="event_type string, records bigint")


@register("plain_parquet_roundtrip", "SELECT * FROM customer")
def q_plain_parquet(spark, sf_dir):
    path = shared_path(spark, "customer")
    sinks.write_parquet(table(spark, sf_dir, "customer"), path)
    return rd.read_parquet(spark, path)


@register("surrogate_order", """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS ids, true AS stable FROM orders""")
def q_surrogate_order(spark, sf_dir):
    """Stored surrogate keys are unique and the same whenever they are read."""
    keyed = sp.add_event_order(table(spark, sf_dir, "orders").select("o_orderkey"))
    again = keyed.select("o_orderkey", F.col("event_order").alias("second"))
    same = F.min(F.col("event_order") == F.col("second")).alias("stable")
    return keyed.join(again, "o_orderkey").agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                               F.countDistinct("event_order").cast("bigint").alias("ids"), same)


@register("strategy_results_equal", f"""
WITH fx2 AS ({FX2_SQL}), s AS (SELECT CAST({_NONEMPTY_SRC} AS DOUBLE) / 4.0 AS r FROM fx2)
SELECT {_band_sql('r')} AS quality_band, CAST(count(*) AS BIGINT) AS records, true AS equal FROM s GROUP BY 1""")
def q_strategy_equal(spark, sf_dir):
    """The band counts of the broadcast, merge and range strategies agree."""
    counts = [_band_distribution(spark, sf_dir, s).select("quality_band", F.col("records").alias(s))
              for s in ("broadcast", "merge", "range")]
    both = counts[0].join(counts[1], "quality_band").join(counts[2], "quality_band")
    equal = (F.col("broadcast") == F.col("merge")) & (F.col("merge") == F.col("range"))
    return both.select("quality_band", F.col("broadcast").alias("records"), equal.alias("equal"))


# --------------------------------------------------------------------------- stored tables

_DOC_PROFILE = ("text", "lang", "source", "n_chars")


@register("incremental_curation", f"""
WITH s AS (SELECT *, CAST({" + ".join(_present_sql(c) for c in _DOC_PROFILE)} AS DOUBLE) / 4.0 AS completeness_ratio FROM documents)
SELECT doc_id, lang, source, completeness_ratio, {_band_sql("completeness_ratio")} AS quality_band,
  lang IS NULL OR lang IN ('es', 'fr') AS rewritten FROM s""")
def q_incremental_curation(spark, sf_dir):
    """Documents curated by language, then again after one language has come in, one has changed and one has gone.

    ``rewritten``: the row's file was not there before the second run. Rows without a language change too.
    """
    docs = table(spark, sf_dir, "documents")
    gone = docs.where("lang = 'en'").withColumn("lang", F.lit("gone"))
    before = (docs.where("lang IS NULL OR lang <> 'es'")
                  .withColumn("n_chars", F.expr("CASE WHEN lang IS NULL OR lang = 'fr' THEN n_chars + 1 ELSE n_chars END")).unionByName(gone))
    folder = shared_path(spark, "incremental")

    def curated(rows):
        profiled = qu.add_row_profile(rows, list(_DOC_PROFILE), with_name_length=False)
        return qu.assign_band(profiled).drop("text")

    inc.write_changed(before, folder, ["lang"], curated)
    inc.write_changed(docs, folder, ["lang"], curated)
    files = inc.read_snapshot(spark, folder, run=1, file_col="file").select(F.col("file").alias("old")).distinct()
    now = inc.read_snapshot(spark, folder, file_col="file")
    return now.join(files, F.col("file") == F.col("old"), "left").select(
        "doc_id", "lang", "source", "completeness_ratio", "quality_band", F.col("old").isNull().alias("rewritten"))


@register("stored_join", """
SELECT d.doc_id, d.lang, d.source, d.n_chars, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q_stored_join(spark, sf_dir):
    """Documents and their labels, both stored in buckets of the id: the join itself has no exchange."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    layout = sj.plan_layout(docs, ["doc_id"], shuffle_partitions(spark))
    labels = sj.store_replicated(table(spark, sf_dir, "labels"), layout)
    joined = sj.join_stored(sj.store_spread(docs, layout), labels, layout, "left")
    return joined.select("doc_id", "lang", "source", "n_chars", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("quality", "toxic")])


@register("stored_join_hot", """
SELECT d.doc_id, d.source, coalesce(s.docs, 0) AS docs, coalesce(s.chars, 0) AS chars FROM documents d
LEFT JOIN (SELECT source, CAST(count(*) AS BIGINT) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source) s USING (source)""")
def q_stored_join_hot(spark, sf_dir):
    """Documents and the totals of their source, stored in buckets of source and salt: a hot source fills many buckets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    layout = sj.plan_layout(docs, ["source"], shuffle_partitions(spark))
    totals = docs.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars"))
    joined = sj.join_stored(sj.store_spread(docs, layout), sj.store_replicated(totals, layout), layout, "left")
    return joined.select("doc_id", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("docs", "chars")])


@register("drifting_json", """
SELECT doc_id, source, CASE WHEN doc_id % 3 = 1 THEN concat('n', n_chars) ELSE CAST(n_chars AS VARCHAR) END AS n_chars,
  CASE WHEN doc_id % 3 = 2 THEN lang END AS lang, text FROM documents""")
def q_drifting_json(spark, sf_dir):
    """Documents written as JSON lines in three deliveries: numbers, then texts in the same field, then one field more."""
    docs, folder = table(spark, sf_dir, "documents"), shared_path(spark, "drifting")
    one = docs.where("doc_id % 3 = 0").select("doc_id", "source", "n_chars", "text")
    two = docs.where("doc_id % 3 = 1").select("doc_id", "source", F.concat(F.lit("n"), F.col("n_chars").cast("string")).alias("n_chars"), "text")
    for part in (one, two, docs.where("doc_id % 3 = 2")):
        part.write.mode("append").json(folder)
    return drift.read_drifting_json(spark, folder).rows.select("doc_id", "source", "n_chars", "lang", "text")


@register("lineage_runs", """
WITH s AS (SELECT coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY 1)
SELECT run_id, step, source AS part, 'ok' AS status, CAST(n AS BIGINT) AS records, CAST(attempt AS INTEGER) AS attempt
FROM s, (VALUES ('first', 'read', 0), ('first', 'write', 1), ('second', 'read', 0)) r(run_id, step, attempt)""")
def q_lineage_runs(spark, sf_dir):
    """Lineage of two runs by source: a step that failed and was tried again, a write stored twice, a late record of the failed attempt."""
    docs, path = table(spark, sf_dir, "documents"), shared_path(spark, "lineage")
    counts = materialize(docs.groupBy(F.coalesce("source", F.lit("")).alias("part")).agg(F.count(F.lit(1)).alias("n")))

    def records(run: str, step: str, status: str = "ok") -> DataFrame:
        details = F.create_map(F.lit("part"), "part", F.lit("records"), F.col("n").cast("string"))
        return counts.select(F.lit(run).alias("run_id"), F.lit(step).alias("step"), F.lit(status).alias("status"),
                             F.lit(RUN_TS).cast("timestamp").alias("timestamp_utc"), details.alias("details"))

    sinks.upsert_lineage(records("first", "read"), path)
    sinks.upsert_lineage(records("first", "write", "error"), path)
    for _ in range(2):
        sinks.upsert_lineage(records("first", "write"), path, attempt=1)
    sinks.upsert_lineage(records("first", "write", "late"), path)
    sinks.upsert_lineage(records("second", "read"), path)
    return sinks.read_lineage(spark, path).select("run_id", "step", F.col("details")["part"].alias("part"), "status",
                                                  F.col("details")["records"].cast("bigint").alias("records"), "attempt")


# --------------------------------------------------------------------------- models

_MODEL_FEATURES = ["lang", "source"], ["n_chars"]


def _model_frames(spark, sf_dir):
    """FX3 split per label class in ``doc_id`` order; features lang, source, n_chars."""
    data = fx3(spark, sf_dir).select("doc_id", "lang", "source", "n_chars", "label")
    # computed once: the three frames are filters of one written split
    split = materialize(sp.stratified_split(data, "label", ["doc_id"]))
    return sp.split_frames(split)


def _trained(spark, sf_dir, models):
    from tabqual.operators import models as mo
    train, val, test = _model_frames(spark, sf_dir)
    return test, mo.train_and_compare(train, val, test, *_MODEL_FEATURES, id_col="doc_id", models=models, parallelism=4)


_MODEL_SPLIT_SQL = f"""WITH s AS (SELECT lang, source, label, percent_rank() OVER (PARTITION BY label ORDER BY doc_id) AS pr
           FROM ({FX3_SQL}) f), train AS (SELECT * FROM s WHERE pr <= 0.7), test AS (SELECT * FROM s WHERE pr > 0.85)"""


@register("model_comparison", f"""{_MODEL_SPLIT_SQL}
SELECT model, (SELECT CAST(count(*) AS BIGINT) FROM test) AS test_rows,
  (SELECT CAST(sum(label) AS BIGINT) FROM test) AS test_positives, true AS auc_agrees, true AS scores_reload
FROM (VALUES ('logistic_regression'), ('random_forest'), ('gbt')) m(model)""")
def q_model_comparison(spark, sf_dir):
    """Trains the three classifiers; what of the comparison does not depend on chance, and two checks of it.

    ``auc_agrees``: the reported test AUC is that of Spark ML's evaluator, unbinned, over the stored predictions.
    ``scores_reload``: a saved and reloaded model scores the test rows alike.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from tabqual.operators import models as mo
    test, trained = _trained(spark, sf_dir, mo.MODEL_NAMES)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    rows = []
    for r in trained.comparison.collect():  # one row per model
        name, pred = r["model"], trained.predictions[r["model"]].select("doc_id", "label", "score")
        path = shared_path(spark, f"model-{name}")
        sinks.save_model(trained.models[name], path)
        again = mo.positive_score(PipelineModel.load(path).transform(test)).select("doc_id", F.col("score").alias("again"))
        differ = pred.join(again, "doc_id").where(F.abs(F.col("score") - F.col("again")) > 1e-12).isEmpty()
        positives = int(pred.agg(F.sum("label")).first()[0] or 0)
        rows.append((name, r["test_rows"], positives, abs(evaluator.evaluate(pred) - r["test_roc_auc"]) < 1e-9, differ))
    return spark.createDataFrame(rows, "model string, test_rows bigint, test_positives bigint, auc_agrees boolean, "
                                       "scores_reload boolean")


@register("feature_importance", f"""{_MODEL_SPLIT_SQL}
SELECT model, (SELECT CAST(count(DISTINCT lang) + count(DISTINCT source) + 3 AS BIGINT) FROM train) AS slots,
  true AS named, true AS adds_to_one FROM (VALUES ('random_forest'), ('gbt')) m(model)""")
def q_feature_importance(spark, sf_dir):
    """Slots of the importances (a slot for each trained value, one for unseen values, one for the number)."""
    imp = _trained(spark, sf_dir, ("random_forest", "gbt"))[1].importances
    return imp.groupBy("model").agg(
        F.count(F.lit(1)).cast("bigint").alias("slots"),
        F.min(F.col("feature_name").rlike("^(lang|source|n_chars)")).alias("named"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("adds_to_one"))


@register("balanced_lr", f"""{_MODEL_SPLIT_SQL}
SELECT 'balanced_logistic' AS model, (SELECT CAST(count(*) AS BIGINT) FROM train) AS train_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM test) AS test_rows, true AS auc_in_range""")
def q_balanced_lr(spark, sf_dir):
    from tabqual.operators import models as mo
    train, _, test = _model_frames(spark, sf_dir)
    out = mo.balanced_logistic(train, test, *_MODEL_FEATURES)
    return out.select("model", "train_rows", "test_rows",
                      (F.col("roc_auc_train").between(0, 1) & F.col("roc_auc_test").between(0, 1)).alias("auc_in_range"))


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
