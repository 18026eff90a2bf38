"""The order statistics on real tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_CHECK
from tabqual.operators.ranking import exact_quantiles, scalable_percent_rank
from tabqual.plans.fixtures import table


def test_bucketed_split_rank_equals_window_on_orders(spark):
    o = table(spark, SF_CHECK, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    got = scalable_percent_rank(o, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], "p")
    w = Window.partitionBy("o_orderstatus").orderBy("o_orderdate", "o_orderkey")
    want = o.withColumn("p", F.percent_rank().over(w))
    diff = got.select("o_orderkey", "p").exceptAll(want.select("o_orderkey", "p")).count()
    assert diff == 0


def test_bracketed_quantiles_equal_duckdb_on_lineitem(spark, duck):
    cols = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"]
    li = table(spark, SF_CHECK, "lineitem")
    got, _ = exact_quantiles(li, cols, 0.5, accuracy=200)
    con = duck(SF_CHECK)
    sql = ", ".join(f"quantile_disc({c}, 0.5)" for c in cols)
    want = con.execute(f"SELECT {sql} FROM lineitem").fetchone()
    assert [float(got[c]) for c in cols] == [float(v) for v in want]
