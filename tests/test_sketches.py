"""Stored sketches: a new or replaced partition, merged counts and quantiles against exact ones."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from tabqual.operators import profile as pr
from tabqual.operators import ranking as rk
from tabqual.operators import sketches as sk
from tabqual.plans.fixtures import table


@pytest.fixture(scope="module")
def orders(spark):
    return table(spark, SF_CHECK, "orders").withColumns({
        "part": F.year("o_orderdate"), "some": F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")),
        "exact": F.col("o_totalprice").cast("decimal(20,3)"), "none": F.lit(None).cast("double")})


def compare(spark, store, whole):
    merged = {r["column"]: r for r in sk.merged_inventory(sk.read_store(spark, store)).collect()}
    want = {r["column"]: r for r in pr.column_inventory(whole.drop("part"), exact=True).collect()}
    assert set(merged) == set(want)
    for c, w in want.items():
        g = merged[c]
        assert (g["data_type"], g["non_null_count"], g["null_count"]) == (w["data_type"], w["non_null_count"], w["null_count"]), c
        assert abs(g["fill_rate"] - w["fill_rate"]) < 1e-12
        assert abs(g["distinct_count"] - w["distinct_count"]) <= 4 * sk.HLL_ERROR * w["distinct_count"] + 1, c


def test_partitions_arrive_and_are_replaced(spark, orders, tmp_path):
    store, years = str(tmp_path / "store"), sorted(r[0] for r in orders.select("part").distinct().collect())
    sk.update_store(orders.where(F.col("part") < years[-1]), store, "part")
    compare(spark, store, orders.where(F.col("part") < years[-1]))
    sk.update_store(orders.where(F.col("part") == years[-1]), store, "part")
    compare(spark, store, orders)
    sk.update_store(orders.where(F.col("part") == years[0]), store, "part")  # once more: no change
    compare(spark, store, orders)
    half = orders.where((F.col("part") == years[0]) & (F.col("o_orderkey") % 2 == 0))
    sk.update_store(half, store, "part")  # replaced by fewer rows
    compare(spark, store, orders.where((F.col("part") > years[0]) | (F.col("o_orderkey") % 2 == 0)))


def test_quantile_bounds_hold_the_exact_quantiles(spark, orders):
    profile = sk.partition_profile(orders, "part")
    cols = ["o_orderkey", "o_totalprice", "some", "exact"]
    got = {(r["column"], r["probability"]): r for r in sk.merged_quantiles(profile, [0.0, 0.15, 0.5, 1.0]).collect()}
    assert {c for c, _ in got} == {*cols, "o_custkey"}
    for p in (0.15, 0.5, 1.0):
        exact, _ = rk.exact_quantiles(orders, cols, p)
        for c in cols:
            r = got[c, p]
            assert r["low_bound"] <= float(exact[c]) <= r["high_bound"], (c, p)


def test_null_partitions_and_odd_names(spark):
    df = spark.createDataFrame([(None, 1, "x"), ("a", 2, None), ("a", None, "x")], "`p q` string, `v.1` int, `__none__` string")
    rows = {(r["ingest_partition"], r["column"]): (r["rows"], r["non_null"]) for r in sk.partition_profile(df, "p q").collect()}
    assert rows == {("__none__", "v.1"): (1, 1), ("__none__", "__none__"): (1, 1), ("a", "v.1"): (2, 1), ("a", "__none__"): (2, 1)}
    assert sk.partition_profile(df.limit(0), "p q").count() == 0
