"""The full quality assessment of one source, as a sequence of Spark jobs.

read -> curate + partitioned write, observed -> validate -> profiles -> label, features,
split -> model comparison -> lineage. Reports are small DataFrames written
as CSV directories. The source is read once, by the job that writes the curated table; validation,
totals, bands and missing values are observed there. Other reports read the written files,
so every report sees exactly the rows that were stored.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tabqual.functions.literals import literal_table
from tabqual.operators import curate as cu
from tabqual.operators import features as fe
from tabqual.operators import models as mo
from tabqual.operators import observed as ob
from tabqual.operators import profile as pr
from tabqual.operators import split as sp
from tabqual.session import materialize
from tabqual.sources import sinks


@dataclass
class AssessmentResult:
    run_id: str
    validation: dict
    reports: dict[str, str] = field(default_factory=dict)
    curated_path: str = ""


def run_assessment(spark: SparkSession, source: DataFrame, out_dir: str, source_name: str = "source",
                   run_ts: dt.datetime | None = None, order_cols: Sequence[str] | None = None,
                   run_models: bool = True, models: Sequence[str] = mo.MODEL_NAMES,
                   cv_parallelism: int = 2) -> AssessmentResult:
    """Assess ``source`` and write curated data and reports below ``out_dir``.

    Validation, totals, bands and missing values describe the rows of this run; the other reports
    describe the curated table. ``order_cols`` is the per-class split order (it should end in a unique
    key); without it a stored surrogate ``event_order`` id is used.
    """
    run_id = uuid.uuid4().hex[:12]
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    lineage = os.path.join(out_dir, "lineage")
    reports: dict[str, str] = {}

    def report(name: str, df: DataFrame, **kw) -> None:
        path = os.path.join(out_dir, "reports", name)
        sinks.write_report_csv(df, path, **kw)
        reports[name] = path

    try:
        curated_path = os.path.join(out_dir, "curated")
        laid_out = cu.layout_for_write(cu.curate(source, run_ts=run_ts))
        # the one scan of the source: validation, totals, bands and missing values are observed on the rows written
        seen = ob.write_observed(laid_out, lambda df: sinks.write_partitioned_parquet(df, curated_path, layout=None), source.columns)
        validation = seen.assert_valid()
        report("ingestion_validation", seen.validation())
        sinks.log_lineage(spark, lineage, run_id, "validate", "ok", validation)
        curated = spark.read.parquet(curated_path)
        sinks.log_lineage(spark, lineage, run_id, "transform", "ok", {"output": curated_path})

        report("summary_totals", seen.totals())
        report("dataset_profile", literal_table(spark, [(seen.rows, len(laid_out.columns), source_name)],
                                                "total_records bigint, total_columns int, source_url string"))
        if "geometry_type" in curated.columns:
            report("geometry_distribution", pr.group_count_desc(curated, "geometry_type"))
        report("quality_band_distribution", seen.band_distribution())
        report("null_profile", seen.null_profile())
        report("column_inventory", pr.column_inventory(curated))
        report("numeric_statistics", pr.numeric_statistics(curated))
        report("top_values_by_column", pr.top_values(curated))
        key = list(order_cols) if order_cols else ["event_order"]
        if not order_cols:
            curated = sp.add_event_order(curated)
        report("sample_records", pr.preview(curated, key, 500), quote_all=True)

        if run_models:
            ml_df, cat_cols, num_cols, spec = fe.prepare_ml_frame(curated, key)
            split = materialize(sp.stratified_split(ml_df, "label", key))
            report("split_class_distribution", sp.split_class_distribution(split))
            train, val, test = sp.split_frames(split)
            id_col = key[-1]
            trained = mo.train_and_compare(train, val, test, cat_cols, num_cols, id_col=id_col, models=models,
                                           parallelism=cv_parallelism)
            report("mllib_model_comparison", trained.comparison)
            report("feature_importance_index", trained.importances)
            report("balanced_baseline", mo.balanced_logistic(train, test, cat_cols, num_cols))
            for name, model in trained.models.items():
                sinks.save_model(model, os.path.join(out_dir, "models", name))
            sinks.log_lineage(spark, lineage, run_id, "models", "ok",
                              {"label_basis": spec.basis_columns, "threshold": spec.threshold})
        sinks.log_lineage(spark, lineage, run_id, "complete", "ok", {"run_models": run_models})
        return AssessmentResult(run_id, validation, reports, curated_path)
    except Exception as exc:
        sinks.log_lineage(spark, lineage, run_id, "complete", "error", {"message": str(exc)})
        raise
