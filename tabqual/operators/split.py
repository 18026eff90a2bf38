"""Per-class ordered split and its class distribution.

Rows of each class are ranked by a caller-given order key with
``percent_rank``: ``<= 0.70`` train, ``(0.70, 0.85]`` validation, ``> 0.85``
test. The order key should end in a unique tie-break so the split is
reproducible (a generated row id depends on partitioning).

``method="scalable"`` computes the same ``percent_rank`` with range buckets
(see :func:`tabqual.operators.ranking.scalable_percent_rank`) so that a class
holding most rows is still sorted by many tasks; ``method="window"`` is the
plain window (one task per class).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabqual.operators.ranking import scalable_percent_rank
from tabqual.session import materialize

# Split boundaries on the per-class percent rank.
TRAIN_MAX = 0.70
VALIDATION_MAX = 0.85


def split_expr(pct: str) -> F.Column:
    p = F.col(pct)
    return (F.when(p <= F.lit(TRAIN_MAX), F.lit("train"))
             .when(p <= F.lit(VALIDATION_MAX), F.lit("validation"))
             .otherwise(F.lit("test")))


def stratified_split(df: DataFrame, label_col: str, order_cols: Sequence[str],
                     method: str = "scalable", buckets: int | None = None,
                     keep_rank: bool = False) -> DataFrame:
    """Add ``split`` (train / validation / test) per class of ``label_col``."""
    order = list(order_cols)
    if method == "window":
        w = Window.partitionBy(label_col).orderBy(*order)
        ranked = df.withColumn("pct_in_label", F.percent_rank().over(w))
    elif method == "scalable":
        ranked = scalable_percent_rank(df, [label_col], order, "pct_in_label", buckets=buckets)
    else:
        raise ValueError(f"unknown split method {method!r}")
    out = ranked.withColumn("split", split_expr("pct_in_label"))
    return out if keep_rank else out.drop("pct_in_label")


def add_event_order(df: DataFrame, col: str = "event_order") -> DataFrame:
    """Surrogate order key when the data has none: a generated unique id.

    The id depends on the partitioning, so the frame is checkpointed right
    away; later passes (and recomputation after a lost executor) read the
    stored ids instead of numbering the rows again.
    """
    return materialize(df.withColumn(col, F.monotonically_increasing_id()))


def split_frames(split_df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test frames (filters on one split column)."""
    return tuple(split_df.where(F.col("split") == F.lit(s)).drop("split")
                 for s in ("train", "validation", "test"))


def split_class_distribution(split_df: DataFrame, label_col: str = "label") -> DataFrame:
    """``split, label, count, ratio``: one grouped count, ratio within each split."""
    counts = split_df.groupBy("split", F.col(label_col).alias("label")).agg(
        F.count(F.lit(1)).cast("bigint").alias("count"))
    total = F.sum("count").over(Window.partitionBy("split"))
    return counts.withColumn("ratio", F.col("count") / total)
