"""Column profiles kept as mergeable sketches, one row for each ingest partition and column.

A profile row holds counts, a HyperLogLog sketch of the values and, for numeric columns, a KLL quantile sketch with minimum,
maximum and moments. When a partition arrives or is replaced, only its own rows are profiled and its own rows of the
store rewritten; the profile of the whole table is merged from the store without another scan of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabqual.functions.columns import qcol, quote, sql_str
from tabqual.functions.missing import safe_ratio_sql

# HyperLogLog with 2^14 registers, KLL with k = 800.
HLL_LOG_K = 14
KLL_K = 800
#: One standard deviation of the relative error of a merged distinct count.
HLL_ERROR = 1.04 / 2 ** (HLL_LOG_K / 2)
#: Rank error (share of the rows) that a KLL sketch of this k keeps with 99 % confidence.
KLL_ERROR = 2.446 / KLL_K ** 0.9433
#: Name of the column that the store is partitioned by.
PARTITION = "ingest_partition"


def _kind(dtype: T.DataType) -> str | None:
    """KLL sketch of a type: whole numbers, other numbers, none."""
    return "bigint" if isinstance(dtype, T.IntegralType) else "double" if isinstance(dtype, T.NumericType) else None


def partition_profile(df: DataFrame, partition: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``ingest_partition, column, data_type, rows, non_null, distinct, quantiles, quantile_kind, low, high, total`` from one scan.

    ``partition`` names the column that tells a row's partition (NULL: ``__none__``). NULL is SQL NULL. Sketches are binary
    columns; those of numbers, and the minimum, maximum and sum, are NULL for other columns. Map columns are left out (no hash).
    """
    cols = [f for f in df.schema.fields if f.name != partition and (columns is None or f.name in columns)
            and not isinstance(f.dataType, T.MapType)]
    key = F.coalesce(qcol(partition).cast("string"), F.lit("__none__")).alias(PARTITION)
    aggs, structs = [F.expr("count(1) AS _rows")], []
    for i, f in enumerate(cols):
        q, kind = quote(f.name), _kind(f.dataType)
        aggs += [F.expr(f"count({q}) AS n{i}"),
                 F.expr(f"hll_sketch_agg(CASE WHEN {q} IS NOT NULL THEN xxhash64({q}) END, {HLL_LOG_K}) AS h{i}")]
        fields = {"column": sql_str(f.name), "data_type": sql_str(f.dataType.simpleString()), "rows": "_rows", "non_null": f"n{i}",
                  "distinct": f"h{i}", "quantiles": "CAST(NULL AS BINARY)", "quantile_kind": "CAST(NULL AS STRING)",
                  "low": "CAST(NULL AS DOUBLE)", "high": "CAST(NULL AS DOUBLE)", "total": "CAST(NULL AS DOUBLE)"}
        if kind:
            v = f"CAST({q} AS {kind})"
            aggs += [F.expr(f"kll_sketch_agg_{kind}({v}, {KLL_K}) AS k{i}"), F.expr(f"CAST(min({v}) AS DOUBLE) AS lo{i}"),
                     F.expr(f"CAST(max({v}) AS DOUBLE) AS hi{i}"), F.expr(f"CAST(sum(CAST({q} AS DOUBLE)) AS DOUBLE) AS s{i}")]
            fields |= {"quantiles": f"k{i}", "quantile_kind": sql_str(kind), "low": f"lo{i}", "high": f"hi{i}", "total": f"s{i}"}
        structs.append("named_struct(" + ", ".join(f"{sql_str(n)}, {e}" for n, e in fields.items()) + ")")
    wide = df.groupBy(key).agg(*aggs)
    return wide.selectExpr(PARTITION, f"inline(array({', '.join(structs)}))")


def update_store(df: DataFrame, store: str, partition: str, columns: Sequence[str] | None = None) -> None:
    """Profile the partitions in ``df`` (whole partitions) and replace their rows of the store; other partitions stay.

    Running it again for the same rows leaves the store as it is.
    """
    profile = partition_profile(df, partition, columns).repartition(PARTITION)
    profile.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(store)


def read_store(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(store)


def merged_inventory(profile: DataFrame) -> DataFrame:
    """The column inventory of all partitions: ``column, data_type, non_null_count, null_count, fill_rate, distinct_count``.

    Counts are exact. Distinct counts are estimates with a relative standard deviation of ``HLL_ERROR``, however many
    partitions are merged. A column that some partitions lack counts as NULL there; a changed type is the largest name.
    """
    n = int(profile.groupBy(PARTITION).agg(F.max("rows").alias("rows")).agg(F.sum("rows")).first()[0] or 0)
    own = profile.groupBy("column").agg(F.max("data_type").alias("data_type"), F.sum("non_null").cast("bigint").alias("non_null_count"),
                                        F.hll_sketch_estimate(F.hll_union_agg("distinct")).cast("bigint").alias("distinct_count"))
    return own.select("column", "data_type", "non_null_count", (F.lit(n).cast("bigint") - F.col("non_null_count")).alias("null_count"),
                      F.expr(safe_ratio_sql("non_null_count", str(n))).alias("fill_rate"), "distinct_count")


def merged_quantiles(profile: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """``column, probability, low_bound, estimate, high_bound`` of the numeric columns, merged over all partitions.

    The bounds are the sketch's values ``KLL_ERROR`` below and above the probability: the exact quantile lies between them
    with 99 % confidence. A numeric column without values has no rows; NaN counts for no sketch.
    """
    parts = []
    for kind in ("bigint", "double"):
        merged = (profile.where(F.col("quantile_kind") == kind).groupBy("column")
                         .agg(F.expr(f"kll_merge_agg_{kind}(quantiles)").alias("sketch"), F.min("low").alias("low"), F.max("high").alias("high"))
                         .where(F.expr(f"kll_sketch_get_n_{kind}(sketch) > 0")))
        for p in probabilities:
            at = {"low_bound": p - KLL_ERROR, "estimate": p, "high_bound": p + KLL_ERROR}
            picks = ["low AS low_bound" if n == "low_bound" and q <= 0 else "high AS high_bound" if n == "high_bound" and q >= 1 else
                     f"CAST(kll_sketch_get_quantile_{kind}(sketch, {min(max(q, 0.0), 1.0)!r}D) AS DOUBLE) AS {n}" for n, q in at.items()]
            parts.append(merged.selectExpr("column", f"{p!r}D AS probability", *picks))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
