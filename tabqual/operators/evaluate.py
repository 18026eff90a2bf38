"""Model evaluation on the cluster: AUCs, bootstrap interval, profit, weights.

Predictions are first aggregated to one row per distinct score (per group),
then curve points come from running sums over the score order
(:func:`tabqual.operators.ranking.ordered_cumulative`). Each distinct score
contributes one trapezoid that depends only on its own row, so no task ever
holds a whole group. The result equals the trapezoid ROC and PR areas of
Spark ML's evaluator without its binning (exact for any number of scores).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabqual.functions.sampling import hash_uniform, poisson1_weight
from tabqual.operators.ranking import ordered_cumulative
from tabqual.session import materialize, shuffle_partitions

# Confusion-matrix payoffs per true positive, false positive
# and false negative, and the hard-decision threshold.
PROFIT_TP = 600
PROFIT_FP = -120
PROFIT_FN = -350
DECISION_THRESHOLD = 0.5
BOOTSTRAP_REPLICATES = 200
# Fixed value: scores sampled for each score bucket of the bootstrap, to place its bounds.
SAMPLED_PER_BUCKET = 64
CI_LEVELS = (0.025, 0.975)


def hard_prediction(score: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    return F.when(score >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def confusion_profit(pred: DataFrame, label_col: str = "label", score_col: str = "score",
                     threshold: float = DECISION_THRESHOLD, group_cols: Sequence[str] = ()) -> DataFrame:
    """``tp, fp, fn, tn, rows, expected_profit`` in one aggregation (no collect)."""
    y = F.col(label_col).cast("int")
    p = hard_prediction(F.col(score_col), threshold)

    def count_when(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")

    out = pred.groupBy(*group_cols).agg(
        count_when((p == 1) & (y == 1)).alias("tp"),
        count_when((p == 1) & (y == 0)).alias("fp"),
        count_when((p == 0) & (y == 1)).alias("fn"),
        count_when((p == 0) & (y == 0)).alias("tn"),
        F.count(F.lit(1)).cast("bigint").alias("rows"),
    )
    profit = (F.col("tp") * PROFIT_TP + F.col("fp") * PROFIT_FP + F.col("fn") * PROFIT_FN).cast("double")
    return out.withColumn("expected_profit", profit)


def _score_table(pred: DataFrame, label_col: str, score_col: str, group_cols: Sequence[str],
                 weight: Column | None) -> DataFrame:
    y = F.col(label_col).cast("double")
    w = F.lit(1.0) if weight is None else weight.cast("double")
    return pred.groupBy(*group_cols, F.col(score_col).cast("double").alias("_s")).agg(
        F.sum(w * y).alias("pos"), F.sum(w * (F.lit(1.0) - y)).alias("neg"))


def _curve_areas(scores: DataFrame, group_cols: Sequence[str], buckets: int | None) -> DataFrame:
    groups = list(group_cols)
    ungrouped = not groups
    if ungrouped:  # one constant group: same plan shape, no cartesian product
        scores, groups = scores.withColumn("_all", F.lit(0)), ["_all"]
    # one row per (group, distinct score)
    cum = ordered_cumulative(scores, groups, ["_s"], ["pos", "neg"], buckets=buckets, with_totals=True)
    cum = cum.withColumnsRenamed({"pos_tot": "P", "neg_tot": "N"})
    tp = F.col("P") - F.col("pos_cum") + F.col("pos")      # positives scored >= s
    fp = F.col("N") - F.col("neg_cum") + F.col("neg")      # negatives scored >= s
    tp_prev, fp_prev = tp - F.col("pos"), fp - F.col("neg")
    # ratios use try_divide: a one-class group gives NULL, not a division error
    prec = F.try_divide(tp, tp + fp)
    prec_prev = F.coalesce(F.try_divide(tp_prev, tp_prev + fp_prev), prec)
    roc_piece = F.col("neg") * (F.lit(2.0) * tp - F.col("pos"))
    pr_piece = F.try_divide(F.col("pos"), F.col("P")) * (prec + prec_prev) / F.lit(2.0)
    per_score = cum.select(*groups, "P", "N", roc_piece.alias("roc_piece"), pr_piece.alias("pr_piece"))
    areas = per_score.groupBy(*groups).agg(
        F.try_divide(F.sum("roc_piece"), F.lit(2.0) * F.first("P") * F.first("N")).alias("roc_auc"),
        F.sum("pr_piece").alias("pr_auc"),
        F.first("P").alias("positives"),
        F.first("N").alias("negatives"),
    )
    return areas.drop("_all") if ungrouped else areas


def auc_metrics(pred: DataFrame, label_col: str = "label", score_col: str = "score",
                group_cols: Sequence[str] = (), weight_col: str | None = None,
                buckets: int | None = None) -> DataFrame:
    """``<groups>, roc_auc, pr_auc, positives, negatives`` (NULL AUC for one-class groups)."""
    weight = F.col(weight_col) if weight_col else None
    scores = _score_table(pred, label_col, score_col, group_cols, weight)
    areas = _curve_areas(scores, group_cols, buckets)
    one_class = (F.col("positives") <= 0) | (F.col("negatives") <= 0)
    return areas.withColumns({
        "roc_auc": F.when(one_class, F.lit(None).cast("double")).otherwise(F.col("roc_auc")),
        "pr_auc": F.when(F.col("positives") <= 0, F.lit(None).cast("double")).otherwise(F.col("pr_auc")),
    })


def bootstrap_weights(pred: DataFrame, id_col: str, replicates: int = BOOTSTRAP_REPLICATES,
                      seed: int = 7) -> DataFrame:
    """One row per (replicate, row) with a Poisson(1) weight > 0, generated inside each task.

    Rows are first hashed on the id over the cluster's cores, so the
    replicate expansion (and its hashing) runs on all of them whatever the
    input's own partitioning; that shuffle moves 1/``replicates`` of the rows
    the replicate aggregation moves afterwards.
    """
    spread = pred.repartition(pred.sparkSession.sparkContext.defaultParallelism, F.col(id_col))
    reps = spread.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    w = poisson1_weight(hash_uniform(F.lit(seed), F.col("rep"), F.col(id_col)))
    return reps.withColumn("_w", w).where(F.col("_w") > 0)


def bootstrap_auc(pred: DataFrame, label_col: str = "label", score_col: str = "score",
                  id_col: str = "id", replicates: int = BOOTSTRAP_REPLICATES, seed: int = 7,
                  buckets: int | None = None) -> DataFrame:
    """ROC-AUC of every bootstrap replicate: ``rep, roc_auc, positives, negatives``.

    The prediction rows are shuffled once, by score range (``buckets`` of them, by default as many as shuffle
    partitions), and expanded into replicates inside each task, so no shuffle carries replicate rows.
    """
    from pyspark.ml.feature import Bucketizer
    base = materialize(pred.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y"),
                                   F.col(score_col).cast("double").alias("_s")))
    splits, hot, salts = _score_splits(base, base.count(), buckets or shuffle_partitions(pred.sparkSession))
    # buckets are contiguous score ranges (NULL scores first, NaN last); a hot
    # score owns its bucket and its rows are spread over ``salts`` tasks by id
    cut = Bucketizer(splits=splits, inputCol="_s", outputCol="_bd", handleInvalid="keep").transform(base)
    bucket = F.when(F.col("_s").isNull(), F.lit(-1)).otherwise(F.col("_bd").cast("int"))
    cols = ["_id", "_y", "_s", bucket.alias("_b")]
    keys = ["_b"]
    if hot:  # a real (non-constant) salt column only when some score is hot
        is_hot = F.col("_s").isin(hot)
        cols.append(F.when(is_hot, F.pmod(F.xxhash64("_id"), F.lit(salts))).otherwise(F.lit(0)).cast("int")
                    .alias("_salt"))
        keys.append("_salt")
    keyed = cut.select(*cols)
    moved = keyed.repartition(len(splits) + len(hot) * salts, *keys)                             # the one row shuffle
    reps = moved.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    w = poisson1_weight(hash_uniform(F.lit(seed), F.col("rep"), F.col("_id"))).cast("double")
    weighted = reps.withColumn("_w", w).where(F.col("_w") > 0)
    # grouping and ordering keys extend the shuffle keys: no further shuffle of replicate rows
    per_score = weighted.groupBy(*keys, "rep", "_s").agg(
        F.sum(F.col("_w") * F.col("_y")).alias("pos"), F.sum(F.col("_w") * (F.lit(1.0) - F.col("_y"))).alias("neg"))
    local = Window.partitionBy(*keys, "rep").orderBy("_s")
    term = F.col("neg") * (F.lit(2.0) * F.sum("pos").over(local) - F.col("pos"))
    per_bucket = (per_score.withColumn("_a", term)
                  .groupBy("rep", "_b").agg(F.sum("pos").alias("bpos"), F.sum("neg").alias("bneg"),
                                            F.sum("_a").alias("_a")))
    hot_buckets = sorted({int(b) for b in _bucket_of(splits, hot)})
    a = F.when(F.col("_b").isin(hot_buckets), F.col("bneg") * F.col("bpos")) if hot_buckets else None
    if a is not None:
        per_bucket = per_bucket.withColumn("_a", a.otherwise(F.col("_a")))
    # per replicate: a small (rep, bucket) table
    before = Window.partitionBy("rep").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = per_bucket.withColumn("_off", F.coalesce(F.sum("bpos").over(before), F.lit(0.0)))
    agg = offs.groupBy("rep").agg(F.sum("bpos").alias("P"), F.sum("bneg").alias("N"),
                                  F.sum(F.col("_off") * F.col("bneg")).alias("_x"), F.sum("_a").alias("_a"))
    two_pn = F.lit(2.0) * F.col("P") * F.col("N")
    roc = F.try_divide(two_pn - F.lit(2.0) * F.col("_x") - F.col("_a"), two_pn)
    return agg.select("rep", roc.alias("roc_auc"), F.col("P").alias("positives"), F.col("N").alias("negatives"))


def _score_splits(base: DataFrame, n: int, buckets: int) -> tuple[list[float], list[float], int]:
    """Bucketizer splits from a seeded sample (``SAMPLED_PER_BUCKET`` scores for each bucket) and the
    hot scores, each given a bucket of its own; returns (splits, hot scores, salts)."""
    frac = min(1.0, SAMPLED_PER_BUCKET * buckets / max(n, 1))
    sample = [r[0] for r in base.select("_s").where(F.col("_s").isNotNull() & ~F.isnan("_s"))
              .sample(False, frac, 17).orderBy("_s").collect()]
    m = len(sample)
    inner: set[float] = set()
    hot: list[float] = []
    salts = 1
    if m:
        counts = Counter(sample)
        cut = max(2.0, m / buckets)
        hot = sorted(v for v, c in counts.items() if c >= cut and math.isfinite(v))
        inner = {sample[(i * m) // buckets] for i in range(1, buckets)}
        for h in hot:
            inner.update((h, math.nextafter(h, math.inf)))
        if hot:
            salts = max(1, math.ceil(max(counts[h] for h in hot) / cut))
    inner = {v for v in inner if math.isfinite(v)}
    return [-math.inf] + sorted(inner) + [math.inf], hot, salts


def _bucket_of(splits: list[float], values: list[float]) -> list[int]:
    """Bucketizer index of each value (the bucket whose lower split is the largest <= value)."""
    import bisect
    return [bisect.bisect_right(splits, v) - 1 for v in values]


def bootstrap_auc_ci(pred: DataFrame, label_col: str = "label", score_col: str = "score",
                     id_col: str = "id", replicates: int = BOOTSTRAP_REPLICATES, seed: int = 7,
                     levels: tuple[float, float] = CI_LEVELS, buckets: int | None = None) -> DataFrame:
    """``auc_ci_low, auc_ci_high, replicates_used``; single-class replicates are skipped,
    (0, 0) when none is left. Quantiles interpolate linearly between replicates."""
    reps = bootstrap_auc(pred, label_col, score_col, id_col, replicates, seed, buckets)
    valid = reps.where((F.col("positives") > 0) & (F.col("negatives") > 0))
    q = F.percentile(F.col("roc_auc"), list(levels))
    return valid.agg(q.alias("_q"), F.count(F.lit(1)).cast("bigint").alias("replicates_used")).select(
        F.coalesce(F.col("_q")[0], F.lit(0.0)).alias("auc_ci_low"),
        F.coalesce(F.col("_q")[1], F.lit(0.0)).alias("auc_ci_high"),
        "replicates_used")


def class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """``<label>, n_class, weight`` with weight = n / (k * n_class) (balanced)."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_class"))
    whole = Window.partitionBy()  # over the per-class counts: one row per class value
    return counts.withColumn(
        "weight", F.sum("n_class").over(whole).cast("double")
        / (F.count(F.lit(1)).over(whole).cast("double") * F.col("n_class").cast("double")))


def with_class_weights(df: DataFrame, label_col: str = "label", weight_col: str = "class_weight") -> DataFrame:
    """Attach the balanced weight of each row's class (small per-class table joined back)."""
    w = class_weights(df, label_col).select(label_col, F.col("weight").alias(weight_col))
    return df.join(w, label_col, "left")


def model_score_mart(*metric_tables: DataFrame, model_col: str = "model",
                     score_col: str = "test_roc_auc") -> DataFrame:
    """Average score per model over several metric tables (unioned, never joined)."""
    union = None
    for t in metric_tables:
        part = t.select(model_col, score_col)
        union = part if union is None else union.unionByName(part)
    return (union.where(F.col(model_col).isNotNull())
                 .groupBy(model_col).agg(F.avg(score_col).alias(f"avg_{score_col}")))
