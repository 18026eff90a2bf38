"""Row-level curation on a streaming DataFrame.

The completeness features, band and dimension join are plain column
expressions plus a stream-static broadcast join, so the batch operators run
unchanged on ``readStream`` input. Two outputs are offered: curated rows
appended to partitioned Parquet, and running band counts (an aggregation in
complete mode, its state keyed by band only, so it stays a few rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabqual.operators import curate as cu
from tabqual.operators.quality import QUALITY_BANDS


def curate_stream(stream: DataFrame, columns: Sequence[str], time_col: str | None = None,
                  run_ts=None, bands=QUALITY_BANDS) -> DataFrame:
    """Curated rows for every micro-batch (same columns as the batch :func:`curate`).

    Either an event-time column or a fixed run time is needed: a time taken when the plan is
    built would stand still for all batches.
    """
    if time_col is None and run_ts is None:
        raise ValueError("give time_col or run_ts")
    return cu.curate(stream, columns=columns, time_col=time_col, run_ts=run_ts,
                     strategy="broadcast", bands=bands)


def band_counts(curated: DataFrame) -> DataFrame:
    """Running ``quality_band, min_ratio, records``."""
    return curated.groupBy("quality_band", "min_ratio").agg(F.count(F.lit(1)).alias("records"))


def start_parquet_sink(curated: DataFrame, path: str, checkpoint: str,
                       partition_cols: Sequence[str] = ("ingest_year", "ingest_month"),
                       trigger_once: bool = False) -> StreamingQuery:
    """Append curated micro-batches as partitioned Parquet (exactly-once, restarts included, via the checkpoint)."""
    writer = (curated.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).partitionBy(*partition_cols))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def start_band_counts(curated: DataFrame, query_name: str, checkpoint: str) -> StreamingQuery:
    """Band counts kept in an in-memory table named ``query_name`` (complete mode)."""
    return (band_counts(curated).writeStream.format("memory").queryName(query_name)
            .outputMode("complete").option("checkpointLocation", checkpoint).start())
