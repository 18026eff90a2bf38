"""Tables whose partitions are rewritten only where their input changed.

Every partition of the input has a fingerprint: its number of rows, the bitwise exclusive or and the sum of its rows' hashes, whatever
their order. Output files lie in a directory named by the fingerprint, which covers the partition's keys, and a manifest lists the fingerprints that
make up the table. A run writes the partitions whose fingerprint the last manifest lacks, then the next manifest. Until that is whole, readers see the
table as it was, so a run that is lost or repeated leaves no half-written partition in sight. Directories that no manifest lists any more are kept:
:func:`read_snapshot` reads earlier runs too.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabqual.functions.columns import qcol, quote, sql_str
from tabqual.session import materialize

#: Column that output directories are told apart by. The keys stay in the files, with their types and empty texts as they are.
FINGERPRINT = "input_fingerprint"


def _hashable(f: T.StructField) -> str:
    """A column as something Spark can hash: entries of a map in key order, variants as JSON, others as they are."""
    q = quote(f.name)
    if isinstance(f.dataType, T.MapType):
        return f"array_sort(map_entries({q}))"
    return f"to_json({q})" if isinstance(f.dataType, T.VariantType) else q


def row_hash_sql(df: DataFrame, seed: int) -> str:
    """64-bit hash of a whole row; which columns are NULL counts too (Spark's hash leaves NULL out)."""
    parts = [str(seed)]
    for f in df.schema.fields:
        parts += [_hashable(f), f"{quote(f.name)} IS NULL"]
    return f"xxhash64({', '.join(parts)})"


def partition_fingerprints(df: DataFrame, keys: Sequence[str], version: str = "") -> DataFrame:
    """``keys..., rows, input_fingerprint`` of every partition of ``df``, by one aggregation with partial sums.

    Equal rows count each time, a NULL key is a partition of its own, and the order of rows does not matter. ``version`` and the names and types
    of the columns are part of the fingerprint. The sum is a decimal, so it cannot overflow.
    """
    groups = [qcol(k) for k in keys]
    sums = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_rows"), F.expr(f"bit_xor({row_hash_sql(df, 1)})").alias("_xor"),
        F.expr(f"sum(CAST({row_hash_sql(df, 2)} AS DECIMAL(20, 0)))").alias("_sum"))
    shape = df.schema.simpleString() + "\n" + version
    own = [F.coalesce(k.cast("string"), F.lit("")) for k in groups] + [k.isNull().cast("string") for k in groups]
    text = F.to_json(F.array(F.lit(shape), *own, *[F.col(c).cast("string") for c in ("_rows", "_xor", "_sum")]))
    return sums.select(*groups, F.col("_rows").alias("rows"), F.md5(text).alias(FINGERPRINT))


def _manifests(spark: SparkSession, table_dir: str) -> DataFrame | None:
    """``run, input_fingerprint, rows, listed, schema`` of all whole manifests; None before the first run."""
    try:
        rows = spark.read.parquet(f"{table_dir}/manifests")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # each manifest ends with a row that says how many partitions it lists: with fewer rows it is not whole
    whole = rows.groupBy("run").agg((F.count(FINGERPRINT) == F.max("listed")).alias("whole")).where("whole")
    return rows.join(whole.select("run"), "run", "left_semi")


def last_run(spark: SparkSession, table_dir: str) -> int:
    """Number of the last whole run, 0 if there is none."""
    seen = _manifests(spark, table_dir)
    return 0 if seen is None else int(seen.agg(F.max("run")).first()[0] or 0)


@dataclass
class Changes:
    """What a run did: partitions of the table, how many of them it wrote, and how many the table lost since the run before."""

    run: int
    partitions: int
    written: int
    gone: int


def write_changed(source: DataFrame, table_dir: str, keys: Sequence[str], transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                  version: str = "") -> Changes:
    """Bring the table below ``table_dir`` up to date with ``source``, partitioned by its columns ``keys``.

    ``transform`` maps rows to rows one by one and keeps the column ``input_fingerprint``; ``version`` must change with it. The result
    equals that of a run that writes every partition. A partition whose rows are as they were keeps its files; one that ``source`` lacks leaves the table; an empty source empties it.
    A run whose input equals the last one's writes the manifest alone. Runs of one table must follow one another.
    """
    spark, keys = source.sparkSession, list(keys)
    now = materialize(partition_fingerprints(source, keys, version))
    seen, run = _manifests(spark, table_dir), last_run(spark, table_dir) + 1
    last = now.limit(0) if seen is None else seen.where((F.col("run") == run - 1) & F.col(FINGERPRINT).isNotNull())
    before = materialize(last.select(FINGERPRINT))
    todo = materialize(now.join(before, FINGERPRINT, "left_anti"))
    n, written, kept = now.count(), todo.count(), now.join(before, FINGERPRINT, "left_semi").count()
    cond = F.lit(True)
    for k in keys:
        cond = cond & source[quote(k)].eqNullSafe(todo[quote(k)])
    rows = source.join(todo, cond).select(*[source[quote(c)] for c in source.columns], todo[FINGERPRINT])
    out = transform(rows)
    if written:
        (out.hint("rebalance", FINGERPRINT).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(FINGERPRINT).parquet(f"{table_dir}/rows"))
    schema = T.StructType([f for f in out.schema.fields if f.name != FINGERPRINT]).json()
    listed = now.select(F.lit(run).alias("run"), FINGERPRINT, "rows", F.lit(None).cast("bigint").alias("listed"),
                        F.lit(None).cast("string").alias("schema"))
    end = spark.range(1).select(F.lit(run).alias("run"), F.lit(None).cast("string").alias(FINGERPRINT), F.lit(None).cast("bigint").alias("rows"),
                                F.lit(n).cast("bigint").alias("listed"), F.lit(schema).alias("schema"))
    # a lost run's rows of the same number are replaced
    (listed.unionByName(end).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{table_dir}/manifests"))
    return Changes(run, n, written, before.count() - kept)


def read_snapshot(spark: SparkSession, table_dir: str, run: int | None = None, file_col: str | None = None) -> DataFrame:
    """The table as the last whole run left it, or as ``run`` did; ``file_col`` names a further column for each row's file.

    The manifest prunes directories, since the fingerprint is a partition column.
    """
    seen = _manifests(spark, table_dir)
    run = run if run is not None else last_run(spark, table_dir)
    if seen is None or seen.where(F.col("run") == run).isEmpty():
        raise ValueError(f"no run {run} of the table {sql_str(table_dir)}")
    own = seen.where(F.col("run") == run)
    listed, end = own.where(F.col(FINGERPRINT).isNotNull()).select(FINGERPRINT), own.where(F.col(FINGERPRINT).isNull()).first()
    schema = T.StructType.fromJson(json.loads(end["schema"]))
    if not end["listed"]:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(file_col, F.lit(None).cast("string")) if file_col else empty
    rows = spark.read.schema(schema.add(FINGERPRINT, "string")).parquet(f"{table_dir}/rows")
    if file_col:
        rows = rows.withColumn(file_col, F.col("_metadata.file_path"))
    return rows.join(listed, FINGERPRINT, "left_semi").drop(FINGERPRINT)
