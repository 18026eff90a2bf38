"""Row completeness, bands, joins and validation on tiny literal frames (FX4)."""

import pytest
from pyspark.sql import functions as F

from tabqual.operators import curate as cu
from tabqual.operators import quality as qu


def test_missing_rule_null_blank_spaces_but_not_tab(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("\t",), ("x",)], "a string")
    out = qu.add_row_profile(df, ["a"]).select("a", "non_empty_fields").collect()
    got = {r["a"]: r["non_empty_fields"] for r in out}
    assert got == {None: 0, "": 0, "  ": 0, "\t": 1, "x": 1}


def test_ratio_and_name_length(spark):
    df = spark.createDataFrame([(1, " ab ", None), (2, None, "r")], "id int, full_name string, review string")
    out = qu.RowProfileTransformer().transform(df).orderBy("id").collect()
    assert [r["non_empty_fields"] for r in out] == [2, 2]
    assert [r["completeness_ratio"] for r in out] == [2 / 3, 2 / 3]
    assert [r["name_length"] for r in out] == [4, 0]  # untrimmed; NULL -> 0


def test_no_columns_gives_ratio_one_and_no_name_length(spark):
    df = spark.range(3)
    out = qu.add_row_profile(df, [])
    assert "name_length" not in out.columns
    assert {r["completeness_ratio"] for r in out.collect()} == {1.0}


def test_names_with_spaces_and_dots(spark):
    df = spark.createDataFrame([("x", None)], "`a b` string, `c.d` string")
    row = qu.add_row_profile(df).first()
    assert row["non_empty_fields"] == 1


@pytest.mark.parametrize("ratio,band", [(0.85, "HIGH"), (0.8499, "MEDIUM"), (0.60, "MEDIUM"),
                                        (0.5999, "LOW"), (0.0, "LOW"), (1.0, "HIGH")])
def test_band_boundaries_inclusive(spark, ratio, band):
    df = spark.createDataFrame([(ratio,)], "completeness_ratio double")
    assert qu.assign_band(df).first()["quality_band"] == band


def test_three_join_strategies_agree(spark):
    rows = [(i, "x" if i % 2 else None, "y" if i % 3 else "  ", None if i % 5 == 0 else "z") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string")
    results = []
    for strategy in ("broadcast", "merge", "range"):
        cur = cu.curate(df, run_ts="2026-01-15 12:00:00", strategy=strategy)
        results.append(sorted((r["id"], r["quality_band"], r["min_ratio"]) for r in cur.collect()))
    assert results[0] == results[1] == results[2]


def test_broadcast_join_plan(spark):
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    from tabqual.sources.sinks import plan_text
    plan = plan_text(cu.curate(df, run_ts="2026-01-15 12:00:00"), "simple")
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_validation_counts_and_errors(spark):
    df = spark.createDataFrame([(None, " "), ("a", None), ("a", "b")], "x string, y string")
    rep = qu.ingestion_validation(df).first()
    assert (rep["total_rows"], rep["total_columns"], rep["completely_empty_rows"]) == (3, 2, 1)
    with pytest.raises(qu.ValidationError):
        qu.assert_valid(qu.ingestion_validation(df.limit(0)))
    with pytest.raises(qu.ValidationError):
        qu.assert_valid(qu.ingestion_validation(spark.range(3).select()))


def test_transformer_save_load_roundtrip(spark, tmp_path):
    t = qu.RowProfileTransformer(columns=["a", "b"])
    path = str(tmp_path / "t")
    t.write().overwrite().save(path)
    loaded = qu.RowProfileTransformer.load(path)
    assert loaded.getColumns() == ["a", "b"]
    df = spark.createDataFrame([("x", None, "z")], "a string, b string, c string")
    assert loaded.transform(df).first()["non_empty_fields"] == 1


def test_run_timestamp_is_fixed(spark):
    df = spark.range(5)
    cur = cu.add_ingest_time(df, run_ts="2026-02-28 23:59:59")
    vals = {(r["ingest_year"], r["ingest_month"]) for r in cur.collect()}
    assert vals == {(2026, 2)}
