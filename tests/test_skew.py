"""A key holding a third or more of all rows must not land in one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabqual.operators import evaluate as ev
from tabqual.operators import profile as pr
from tabqual.operators.ranking import with_ranges


def _hot_frame(spark, n=6000):
    # label "hot" holds half of the rows, with unique order keys
    return spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 5).cast("string")))
         .alias("label"),
        F.col("id").alias("k"))


def test_hot_group_is_spread_over_buckets(spark):
    df = _hot_frame(spark)
    sizes = with_ranges(df, ["label", "k"], 8).where("label = 'hot'").groupBy("_bucket").count().collect()
    hot = 3000
    assert len(sizes) >= 3
    assert max(r["count"] for r in sizes) < 0.6 * hot


def test_ranges_are_monotone(spark):
    b = with_ranges(_hot_frame(spark, 2000), ["label", "k"], 6)
    w = Window.orderBy("label", "k")
    bad = b.withColumn("prev", F.lag("_bucket").over(w)).where(F.col("prev") > F.col("_bucket")).count()
    assert bad == 0


def test_hot_score_auc_exact(spark):
    # one score value holds 40 % of rows
    rows = [(i, i % 3 == 0, 0.5 if i % 5 < 2 else (i % 97) / 97.0) for i in range(3000)]
    df = spark.createDataFrame([(i, int(y), s) for i, y, s in rows], "id int, label int, score double")
    pos = [s for _, y, s in rows if y]
    neg = [s for _, y, s in rows if not y]
    # pairwise count via sorting (exact, ties count one half)
    import bisect
    neg_sorted = sorted(neg)
    tot = sum(bisect.bisect_left(neg_sorted, p) + 0.5 * (bisect.bisect_right(neg_sorted, p) - bisect.bisect_left(neg_sorted, p))
              for p in pos)
    want = tot / (len(pos) * len(neg))
    got = ev.auc_metrics(df, buckets=8).first()["roc_auc"]
    assert abs(got - want) < 1e-12


def test_hot_value_top_values_and_counts(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        (F.col("id") % 50).cast("string")).alias("v"))
    top = {r["value"]: r["count"] for r in pr.top_values(df, ["v"], k=2).collect()}
    assert top["hot"] == 3000 and len(top) == 2
    assert pr.group_count_desc(df, "v").first()["records"] == 3000
