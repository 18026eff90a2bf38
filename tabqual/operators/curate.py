"""Curation: run timestamp, quality band, dimension join, partitioned layout.

Join strategies for the band dimension (all give the same rows):

* ``broadcast`` - hash join with the dimension broadcast. The dimension holds
  one row per configured band, so its size is bounded by a parameter, not by
  the data.
* ``merge`` - sort-merge join (both sides shuffled, rows salted, since three bands
  are too few keys to deal rows out by); kept as the comparison strategy.
* ``range`` - threshold range join ``ratio >= lo AND (hi IS NULL OR ratio < hi)``
  against the broadcast band ranges; needs no precomputed band column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabqual.functions.columns import qcol
from tabqual.operators.quality import (
    QUALITY_BANDS,
    add_row_profile,
    assign_band,
    band_dimension,
    band_range_dimension,
)
from tabqual.session import shuffle_partitions


def add_ingest_time(df: DataFrame, run_ts: dt.datetime | str | None = None,
                    time_col: str | None = None) -> DataFrame:
    """Add ``ingested_at``, ``ingest_year``, ``ingest_month``.

    The run timestamp is an argument so that every re-evaluation of the plan
    (cache, retry, second action) sees the same value. ``time_col`` instead
    derives the partition keys from an event-time column of the data.
    """
    if time_col is not None:
        ts = F.col(time_col).cast("timestamp")
    elif run_ts is None:
        ts = F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")
    else:
        ts = F.lit(run_ts).cast("timestamp")
    return df.withColumns({"ingested_at": ts}).withColumns({
        "ingest_year": F.year("ingested_at"),
        "ingest_month": F.month("ingested_at"),
    })


def join_band_dimension(scored: DataFrame, strategy: str = "broadcast",
                        bands: Sequence[tuple[str, float]] = QUALITY_BANDS,
                        ratio_col: str = "completeness_ratio") -> DataFrame:
    """Attach ``min_ratio`` (and, for ``range``, the band itself)."""
    spark = scored.sparkSession
    if strategy == "range":
        ranges = band_range_dimension(spark, bands)
        ratio = F.col(ratio_col)
        cond = (ratio >= F.col("range_lo")) & (F.col("range_hi").isNull() | (ratio < F.col("range_hi")))
        base = scored.drop("quality_band") if "quality_band" in scored.columns else scored
        return base.join(F.broadcast(ranges), cond, "left").drop("range_lo", "range_hi")
    dim = band_dimension(spark, bands)
    if strategy == "broadcast":
        return scored.join(F.broadcast(dim), "quality_band", "left")
    if strategy == "merge":
        # the bands are few: each is dealt out under as many salts as there are shuffle partitions
        salts = shuffle_partitions(spark)
        dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salt = F.pmod(F.xxhash64(*[qcol(c) for c in scored.columns]), F.lit(salts)).cast("int")
        joined = scored.withColumn("_salt", salt).join(dim.hint("merge"), ["quality_band", "_salt"], "left").drop("_salt")
        return joined.select("quality_band", *[qcol(c) for c in joined.columns if c != "quality_band"])
    raise ValueError(f"unknown join strategy {strategy!r}")


def curate(df: DataFrame, columns: Sequence[str] | None = None, run_ts=None,
           time_col: str | None = None, strategy: str = "broadcast",
           bands: Sequence[tuple[str, float]] = QUALITY_BANDS,
           with_name_length: bool = True) -> DataFrame:
    """Source rows -> curated rows (profile, ingest time, band, ``min_ratio``)."""
    cols = list(df.columns if columns is None else columns)
    profiled = add_row_profile(df, cols, with_name_length=with_name_length)
    timed = add_ingest_time(profiled, run_ts=run_ts, time_col=time_col)
    if strategy == "range":
        return join_band_dimension(timed, "range", bands)
    return join_band_dimension(assign_band(timed, bands=bands), strategy, bands)


def layout_for_write(df: DataFrame, partition_cols: Sequence[str] = ("ingest_year", "ingest_month"),
                     method: str = "rebalance", spread_cols: Sequence[str] | None = None,
                     num_partitions: int | None = None) -> DataFrame:
    """Shuffle so that each output directory is written by as many tasks as its size needs.

    Hash-repartitioning on the partition columns alone sends a whole partition
    value (with a run timestamp: the whole table) to one task. ``rebalance``
    clusters rows by the partition columns and lets adaptive execution split
    any oversized partition into several write tasks; ``hash`` adds row-level
    spread columns to the hash key instead.
    """
    if method == "rebalance":
        return df.hint("rebalance", *partition_cols)
    spread = list(spread_cols) if spread_cols else [c for c in df.columns if c not in partition_cols]
    keys = [F.col(c) for c in list(partition_cols) + spread]
    if num_partitions:
        return df.repartition(num_partitions, *keys)
    return df.repartition(*keys)
