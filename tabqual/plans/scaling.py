"""Scaling and strategy measurements (the benchmark side of the library).

Timings are wall-clock around Spark actions, with a warm-up run and the
median of several repeats. Inputs are materialised before timing (a lazy
``cache()`` would otherwise charge the scan to the first query), and row
counts are the real counts: when a larger input is wanted, rows are
replicated, never requested through a ``limit`` the table cannot fill.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabqual.operators import curate as cu
from tabqual.operators import profile as pr
from tabqual.sources import sinks

# Fixed value: price of one core-hour used for the cost estimate.
COST_PER_CORE_HOUR = 0.06

METRICS_SCHEMA = "mode string, rows bigint, partitions bigint, seconds double"


def timed(action: Callable[[], object], repeats: int = 3, warmup: int = 1) -> float:
    """Median wall-clock seconds of ``action`` after ``warmup`` untimed runs."""
    for _ in range(warmup):
        action()
    runs = []
    for _ in range(max(1, repeats)):
        t0 = time.perf_counter()
        action()
        runs.append(time.perf_counter() - t0)
    return statistics.median(runs)


def replicate(df: DataFrame, factor: int) -> DataFrame:
    """``factor`` copies of every row (copy number in ``_copy``), generated in each task."""
    if factor <= 1:
        return df.withColumn("_copy", F.lit(0))
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))


def benchmark_query(df: DataFrame, key: str = "ingest_year", ratio: str = "completeness_ratio") -> DataFrame:
    """The scaling query: rows and mean completeness per ingest year."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.avg(ratio).alias("avg_comp"))


def materialized(df: DataFrame, partitions: int) -> DataFrame:
    """Repartition, persist and count, so timing starts from cached partitions."""
    cached = df.repartition(partitions).persist(StorageLevel.MEMORY_AND_DISK)
    cached.count()
    return cached


def strong_scaling(df: DataFrame, partitions: Sequence[int], repeats: int = 3) -> list[tuple]:
    """Same rows, more partitions: ``(mode, rows, partitions, seconds)`` per setting."""
    out = []
    for p in partitions:
        cached = materialized(df, p)
        n = cached.count()
        secs = timed(lambda: benchmark_query(cached).collect(), repeats)
        out.append(("strong", n, p, secs))
        cached.unpersist()
    return out


def weak_scaling(df: DataFrame, partitions: Sequence[int], base_partitions: int | None = None,
                 repeats: int = 3) -> list[tuple]:
    """Rows grow with partitions: the input is replicated ``p / p0`` times."""
    p0 = base_partitions or min(partitions)
    out = []
    for p in partitions:
        cached = materialized(replicate(df, max(1, p // p0)), p)
        n = cached.count()
        secs = timed(lambda: benchmark_query(cached).collect(), repeats)
        out.append(("weak", n, p, secs))
        cached.unpersist()
    return out


def scaling_cost(metrics: DataFrame, cost_per_core_hour: float = COST_PER_CORE_HOUR) -> DataFrame:
    """Add ``rows_per_second``, ``core_hours`` and ``estimated_cost``."""
    core_hours = F.col("seconds") / F.lit(3600.0) * F.col("partitions")
    return metrics.withColumns({
        "rows_per_second": F.col("rows") / F.col("seconds"),
        "core_hours": core_hours,
        "estimated_cost": core_hours * F.lit(cost_per_core_hour),
    })


def scaling_report(spark: SparkSession, strong: list[tuple], weak: list[tuple],
                   cost_per_core_hour: float = COST_PER_CORE_HOUR) -> DataFrame:
    """Strong and weak rows in one table (union by name) with throughput and cost."""
    s = spark.createDataFrame(strong, METRICS_SCHEMA)
    w = spark.createDataFrame(weak, METRICS_SCHEMA)
    return scaling_cost(s.unionByName(w), cost_per_core_hour)


def compare_strategies(source: DataFrame, out_dir: str, run_ts, columns: Sequence[str] | None = None,
                       repeats: int = 1) -> tuple[DataFrame, bool]:
    """Old (sort-merge join, plain write, no cache) vs new (broadcast join,
    rebalanced partitioned write, cached queries); both must give equal results.

    Returns the runtime table ``mode, transform_seconds, cache_materialize_seconds,
    summary_seconds, quality_band_seconds`` and whether the results agreed.
    """
    spark = source.sparkSession
    rows, results = [], {}
    for mode in ("old", "new"):
        strategy = "merge" if mode == "old" else "broadcast"
        curated = cu.curate(source, columns=columns, run_ts=run_ts, strategy=strategy, with_name_length=False)
        path = f"{out_dir}/curated_{mode}"
        if mode == "old":
            t_transform = timed(lambda: sinks.write_parquet(curated, path), repeats, warmup=0)
            work, t_cache = curated, 0.0
        else:
            t_transform = timed(lambda: sinks.write_partitioned_parquet(curated, path), repeats, warmup=0)
            curated.write.format("noop").mode("overwrite").save()  # warm-up: the cache is timed, not code generation
            work = curated.persist(StorageLevel.MEMORY_AND_DISK)
            t_cache = timed(lambda: work.count(), 1, warmup=0)
        totals = pr.summary_totals(work)
        bands = pr.group_count_desc(work, "quality_band")
        t_sum = timed(lambda: totals.collect(), repeats, warmup=0)
        t_band = timed(lambda: bands.collect(), repeats, warmup=0)
        results[mode] = (sorted(map(tuple, totals.collect())), sorted(map(tuple, bands.collect())))
        if mode == "new":
            work.unpersist()
        rows.append((mode, t_transform, t_cache, t_sum, t_band))
    table = spark.createDataFrame(rows, "mode string, transform_seconds double, cache_materialize_seconds double, "
                                        "summary_seconds double, quality_band_seconds double")
    return table, results["old"] == results["new"]
