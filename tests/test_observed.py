"""Reports observed by the write: against the scanning reports, and the number of times the source is read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tabqual.operators import curate as cu
from tabqual.operators import observed as ob
from tabqual.operators import profile as pr
from tabqual.operators import quality as qu
from tabqual.plans.assessment import run_assessment
from tabqual.plans.fixtures import FX2_SOURCE_COLUMNS, fx2
from tabqual.sources import sinks

TS = dt.datetime(2026, 1, 15)


def rows(df):
    return [tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in df.collect()]


@pytest.mark.parametrize("shuffles", [1, 7])
def test_observed_reports_equal_scanned_ones(spark, tmp_path, shuffles):
    source = fx2(spark, SF_SMALL).select(*FX2_SOURCE_COLUMNS).repartition(shuffles)
    laid_out = cu.layout_for_write(cu.curate(source, run_ts=TS))
    seen = ob.write_observed(laid_out, lambda df: sinks.write_partitioned_parquet(df, str(tmp_path), layout=None), source.columns)
    written = spark.read.parquet(str(tmp_path))
    assert rows(seen.validation()) == rows(qu.ingestion_validation(source)) and rows(seen.totals()) == rows(pr.summary_totals(written))
    assert rows(seen.band_distribution()) == rows(pr.group_count_desc(written, "quality_band"))
    assert rows(seen.null_profile()) == rows(pr.null_profile(written))


def test_an_empty_table_is_not_valid(spark, tmp_path):
    source = spark.createDataFrame([], "a string, `b c` int")
    laid_out = cu.layout_for_write(cu.curate(source, run_ts=TS))
    seen = ob.write_observed(laid_out, lambda df: sinks.write_partitioned_parquet(df, str(tmp_path / "x"), layout=None), source.columns)
    assert seen.rows == 0 and rows(seen.validation()) == [(0, 2, 0)] and seen.band_distribution().count() == 0
    with pytest.raises(qu.ValidationError):
        seen.assert_valid()


def test_the_assessment_reads_its_source_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    plain = fx2(spark, SF_SMALL).select(*FX2_SOURCE_COLUMNS)
    source = plain.mapInPandas(counted, plain.schema)
    res = run_assessment(spark, source, str(tmp_path), run_models=False, order_cols=["record_id"], run_ts=TS)
    assert read.value == plain.count() == res.validation["total_rows"]
    nulls = spark.read.option("header", True).csv(res.reports["null_profile"])
    assert {r["column"]: int(r["null_count"]) for r in nulls.collect()} == {
        r["column"]: r["null_count"] for r in pr.null_profile(spark.read.parquet(res.curated_path)).collect()}


def test_models_can_be_trained_in_the_session_after_an_observation(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    source = fx2(spark, SF_SMALL).select(*FX2_SOURCE_COLUMNS)
    laid_out = cu.layout_for_write(cu.curate(source, run_ts=TS))
    ob.write_observed(laid_out, lambda df: sinks.write_partitioned_parquet(df, str(tmp_path), layout=None), source.columns)
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(40).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 3).cast("double").alias("x")))
    assert LogisticRegression().fit(data).transform(data).select("probability").count() == 40
    assert len(LogisticRegression().fit(data).transform(data).select("probability").collect()) == 40
