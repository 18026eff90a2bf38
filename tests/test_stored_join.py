"""Stored joins: plans without an exchange, and the plain join's rows for hot, NULL, repeated and missing keys."""

import pytest
from pyspark.sql import functions as F

from tabqual.operators import stored_join as sj
from tabqual.sources import sinks


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_rows_of_the_plain_join(spark, how):
    left = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 2 = 0 THEN NULL ELSE concat('k', id % 700) END AS `the key`",
                                        "id % 40 AS v", "id AS `_salts_`")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k1", 3), (None, 4), ("none", 5)], "`the key` string, w int")
    layout = sj.plan_layout(left, ["the key"], 6)
    a, b = sj.store_spread(left, layout), sj.store_replicated(right, layout)
    out = sj.join_stored(a, b, layout, how)
    assert rows(out) == rows(left.join(right, ["the key"], how))
    plan = sinks.plan_text(out, "formatted")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert layout.hot.count() < 6 and {r[0] for r in layout.hot.collect()} == {"hot", None}
    spread = a.where("`the key` = 'hot'").groupBy(F.input_file_name()).count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 1000


def test_empty_sides(spark):
    empty, one = spark.createDataFrame([], "k int, v int"), spark.createDataFrame([(1, 2)], "k int, w int")
    layout = sj.plan_layout(empty, ["k"], 4)
    assert sj.join_stored(sj.store_spread(empty, layout), sj.store_replicated(one, layout), layout).count() == 0
    layout = sj.plan_layout(one, ["k"], 4)
    kept = sj.join_stored(sj.store_spread(one, layout), sj.store_replicated(empty, layout), layout, "left")
    assert rows(kept) == ["(1, 2, None)"]
    with pytest.raises(ValueError):
        sj.join_stored(one, one, layout, "outer")
