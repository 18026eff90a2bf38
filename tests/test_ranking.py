"""Scalable order statistics against brute force and plain windows."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabqual.operators.ranking import exact_quantiles, ordered_cumulative, scalable_percent_rank


def _disc(values, q):
    vals = sorted(v for v in values if v is not None)
    return vals[max(1, math.ceil(q * len(vals))) - 1] if vals else None


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_exact_quantiles_match_brute_force(spark, accuracy):
    rnd = random.Random(3)
    a = [rnd.randint(0, 50) for _ in range(3000)]            # heavy ties
    b = [rnd.random() * 1000 for _ in range(3000)]           # continuous
    c = [7 if i % 3 else rnd.randint(0, 100) for i in range(3000)]  # one hot value (2/3 of rows)
    d = [None if i % 4 else float(i) for i in range(3000)]   # mostly NULL
    df = spark.createDataFrame(list(zip(a, b, c, d)), "a int, b double, c int, d double")
    for q in (0.15, 0.5, 0.9):
        got, _ = exact_quantiles(df, ["a", "b", "c", "d"], q, accuracy=accuracy)
        for name, vals in zip("abcd", (a, b, c, d)):
            assert got[name] == pytest.approx(_disc(vals, q)), (name, q)


def test_exact_quantile_of_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], 0.5)[0] == {"x": None}


@pytest.mark.parametrize("buckets", [1, 7])
def test_ordered_cumulative_matches_window(spark, buckets):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), rnd.randint(0, 40), rnd.randint(1, 9)) for _ in range(800)]
    rows += [("c", 1, 1)] * 300   # hot group with one tied key
    rows += [(None, rnd.randint(0, 40), 2) for _ in range(50)]   # a NULL group is a group
    df = spark.createDataFrame(rows, "g string, k int, v int")
    got = ordered_cumulative(df, ["g"], ["k"], ["v"], buckets=buckets, rank_col="rk", count_col="n")
    w = Window.partitionBy("g").orderBy("k")
    want = df.withColumns({"v_cum": F.sum("v").over(w), "rk": F.rank().over(w),
                           "n": F.count(F.lit(1)).over(Window.partitionBy("g"))})
    key = ["g", "k", "v", "v_cum", "rk", "n"]
    assert Counter(map(tuple, got.select(*key).collect())) == Counter(map(tuple, want.select(*key).collect()))


def test_scalable_percent_rank_equals_window(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice(["x", "y", "z"]), rnd.randint(0, 30), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "label string, d int, id int")
    got = scalable_percent_rank(df, ["label"], ["d"], "p", buckets=5)
    want = df.withColumn("p", F.percent_rank().over(Window.partitionBy("label").orderBy("d")))
    g = {r["id"]: r["p"] for r in got.collect()}
    w = {r["id"]: r["p"] for r in want.collect()}
    assert g == pytest.approx(w)


@pytest.mark.parametrize("order", [["d", "id"], ["s"]])
def test_ordered_cumulative_composite_and_string_keys(spark, order):
    rnd = random.Random(13)
    rows = [(rnd.choice(["x", "y"]), rnd.randint(0, 20), i, f"s{rnd.randint(0, 60):03d}") for i in range(1200)]
    df = spark.createDataFrame(rows, "label string, d int, id int, s string")
    got = ordered_cumulative(df.withColumn("one", F.lit(1)), ["label"], order, ["one"], buckets=6, rank_col="rk")
    w = Window.partitionBy("label").orderBy(*order)
    want = df.withColumns({"one_cum": F.count(F.lit(1)).over(w), "rk": F.rank().over(w)})
    g = sorted((r["id"], r["one_cum"], r["rk"]) for r in got.collect())
    e = sorted((r["id"], r["one_cum"], r["rk"]) for r in want.collect())
    assert g == e


def test_null_order_keys_sort_first(spark):
    rows = [(i % 2, None if i % 5 == 0 else f"k{i % 7}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, s string, v long")
    got = ordered_cumulative(df, ["g"], ["s"], ["v"], buckets=6)
    want = df.withColumn("v_cum", F.sum("v").over(Window.partitionBy("g").orderBy("s")))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.select(*got.columns).collect()))


HARD = {
    "infinite": ("double", [float("-inf")] * 30 + [float(i) for i in range(100)] + [float("inf")] * 40 + [float("nan")] * 20),
    "extreme": ("double", [-1.7e308, 1.7e308] * 20 + [0.0, 1e-300, -1e-300]),
    "near 2^60": ("bigint", [(1 << 60) + i for i in range(300)]),
    "decimal": ("decimal(38,18)", None),
}


@pytest.mark.parametrize("name", list(HARD))
@pytest.mark.parametrize("q", [0.0, 0.15, 0.5, 1.0])
def test_exact_quantiles_of_hard_columns_equal_percentile_disc(spark, name, q):
    kind, values = HARD[name]
    if values is None:
        from decimal import Decimal
        values = [Decimal(f"12345678901234567.{i:018d}") for i in range(200)]
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    got = exact_quantiles(df, ["x"], q, accuracy=50)[0]["x"]
    ordered = [r[0] for r in df.orderBy("x").collect()]
    want = ordered[max(1, math.ceil(q * len(ordered))) - 1]
    assert got == want or (got != got and want != want)


def test_quantiles_take_two_scans_and_no_single_task(spark, tmp_path, monkeypatch):
    from tabqual.operators import ranking
    df = spark.range(20_000).withColumn("x", (F.col("id") * 7919 % 10_007).cast("double"))
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plans, ordered = [], ranking.ordered_cumulative

    def spy(counted, *args, **kw):
        plans.append(counted._jdf.queryExecution().executedPlan().toString())
        return ordered(counted, *args, **kw)

    monkeypatch.setattr(ranking, "ordered_cumulative", spy)
    assert ranking.exact_quantiles(stored, ["id", "x"], 0.5)[0]["id"] == 9999
    assert len(plans) == 1  # one for all value types, beside the first scan
    assert all("SinglePartition" not in p for p in plans)


def test_a_wrong_or_stored_bracket_still_gives_the_exact_quantile(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 31 % 977).cast("double").alias("x"), F.col("id").cast("decimal(20,2)").alias("d"),
                                  F.lit(float("nan")).alias("nan"), F.lit(None).cast("int").alias("none"))
    want, _ = exact_quantiles(df, df.columns, 0.3)
    assert want["id"] == 1499 and want["none"] is None and math.isnan(want["nan"])
    for bounds in ({"id": (-9, -5), "x": (1e9, 2e9)}, {"id": (1400, 1600), "d": (1499.0, 1499.0)}):
        got, _ = exact_quantiles(df, df.columns, 0.3, bounds=bounds)
        assert {c: v for c, v in got.items() if c != "nan"} == {c: v for c, v in want.items() if c != "nan"}


def test_twenty_columns_of_all_types_in_one_scan(spark):
    df = spark.range(3000).select(*[(F.col("id") * (i + 3) % 701 - 200).cast(t).alias(f"c{i}")
                                    for i, t in enumerate(["int", "double", "bigint", "decimal(12,3)", "float"] * 4)])
    got, _ = exact_quantiles(df, df.columns, 0.7)
    rows = df.collect()
    assert all(got[c] == _disc([r[c] for r in rows], 0.7) for c in df.columns)
