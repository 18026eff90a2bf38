"""Assessment run, streaming curation, model save/load and sinks on small inputs."""

import datetime as dt
import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tabqual.operators import curate as cu
from tabqual.operators import profile as pr
from tabqual.plans import catalog
from tabqual.plans.assessment import run_assessment
from tabqual.plans.fixtures import FX2_SOURCE_COLUMNS, fx2
from tabqual.plans.scaling import compare_strategies, scaling_report, strong_scaling, weak_scaling
from tabqual.sources import sinks
from tabqual.streaming import curation as st


def test_assessment_without_models(spark, tmp_path):
    src = fx2(spark, SF_SMALL).select(*FX2_SOURCE_COLUMNS)
    res = run_assessment(spark, src, str(tmp_path), run_models=False, order_cols=["record_id"],
                         run_ts=dt.datetime(2026, 1, 15))
    assert res.validation["total_rows"] == src.count()
    bands = spark.read.option("header", True).csv(res.reports["quality_band_distribution"])
    assert sum(int(r["records"]) for r in bands.collect()) == src.count()
    status = sinks.lineage_status(sinks.read_lineage(spark, os.path.join(str(tmp_path), "lineage"))).first()
    assert status["failed_steps"] == 0 and status["steps"] == 3


def test_assessment_with_logistic_model_and_saved_model(spark, tmp_path):
    src = fx2(spark, SF_SMALL).select(*FX2_SOURCE_COLUMNS, "amount")
    res = run_assessment(spark, src, str(tmp_path), models=["logistic_regression"], order_cols=["record_id"],
                         run_ts=dt.datetime(2026, 1, 15))
    comp = spark.read.option("header", True).csv(res.reports["mllib_model_comparison"]).collect()
    assert [r["model"] for r in comp] == ["logistic_regression"]
    model = PipelineModel.load(os.path.join(str(tmp_path), "models", "logistic_regression"))
    assert len(model.stages) >= 2


def test_streaming_band_counts_match_batch(spark, tmp_path):
    src = fx2(spark, SF_SMALL).select(*FX2_SOURCE_COLUMNS)
    inbox = str(tmp_path / "inbox")
    src.repartition(3).write.parquet(inbox)
    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    curated = st.curate_stream(stream, FX2_SOURCE_COLUMNS, run_ts="2026-01-15 12:00:00")
    q = st.start_band_counts(curated, "tabqual_bands", checkpoint=str(tmp_path / "ckpt"))
    try:
        q.processAllAvailable()
        got = {r["quality_band"]: r["records"] for r in spark.table("tabqual_bands").collect()}
    finally:
        q.stop()
    batch = cu.curate(src, run_ts="2026-01-15 12:00:00")
    want = {r["quality_band"]: r["records"] for r in pr.group_count_desc(batch, "quality_band").collect()}
    assert got == want


def test_streaming_parquet_sink(spark, tmp_path):
    src = fx2(spark, SF_SMALL).select(*FX2_SOURCE_COLUMNS)
    inbox = str(tmp_path / "inbox")
    src.write.parquet(inbox)
    stream = spark.readStream.schema(src.schema).parquet(inbox)
    curated = st.curate_stream(stream, FX2_SOURCE_COLUMNS, run_ts="2026-01-15 12:00:00")
    out = str(tmp_path / "out")
    q = st.start_parquet_sink(curated, out, checkpoint=str(tmp_path / "ck"), trigger_once=True)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == src.count()


def test_scaling_reports_real_rows(spark):
    cur = cu.curate(fx2(spark, SF_SMALL), columns=FX2_SOURCE_COLUMNS, time_col="event_ts")
    n = cur.count()
    strong = strong_scaling(cur, [2, 4], repeats=1)
    weak = weak_scaling(cur, [2, 4], repeats=1)
    assert [r[1] for r in strong] == [n, n]
    assert [r[1] for r in weak] == [n, 2 * n]
    rep = scaling_report(spark, strong, weak).collect()
    assert all(r["rows_per_second"] > 0 and r["estimated_cost"] > 0 for r in rep)


def test_old_and_new_strategies_agree(spark, tmp_path):
    src = fx2(spark, SF_SMALL).select(*FX2_SOURCE_COLUMNS)
    table, equal = compare_strategies(src, str(tmp_path), catalog.RUN_TS)
    assert equal
    assert {r["mode"] for r in table.collect()} == {"old", "new"}


def test_plan_text_has_all_levels(spark):
    df = cu.curate(fx2(spark, SF_SMALL).select(*FX2_SOURCE_COLUMNS), run_ts=catalog.RUN_TS)
    text = sinks.plan_text(df)
    for level in ("Parsed Logical Plan", "Analyzed Logical Plan", "Optimized Logical Plan", "Physical Plan"):
        assert level in text


def test_assessment_without_order_key_uses_event_order(spark, tmp_path):
    src = fx2(spark, SF_SMALL).select(*FX2_SOURCE_COLUMNS, "amount")
    res = run_assessment(spark, src, str(tmp_path), models=["logistic_regression"], run_ts=dt.datetime(2026, 1, 15))
    dist = spark.read.option("header", True).csv(res.reports["split_class_distribution"])
    assert sum(int(r["count"]) for r in dist.collect()) == src.count()
