"""Physical-plan properties that matter at scale."""

import os
import re

from pyspark.sql import functions as F

from conftest import SF_CHECK
from tabqual.operators import curate as cu
from tabqual.operators import profile as pr
from tabqual.operators import split as sp
from tabqual.plans import catalog
from tabqual.plans.fixtures import FX2_SOURCE_COLUMNS, fx2, table
from tabqual.sources import sinks


def plan(df):
    return sinks.plan_text(df, "simple")


def test_write_layout_never_funnels_into_one_task(spark, tmp_path):
    """P3: a run-constant partition value must still be written by several tasks."""
    # several map tasks, as any large input has; AQE splits the hot reducer by map ranges
    src = fx2(spark, SF_CHECK).select(*FX2_SOURCE_COLUMNS).repartition(8)
    cur = cu.curate(src, run_ts=catalog.RUN_TS)
    laid = cu.layout_for_write(cur)
    assert "SinglePartition" not in plan(laid)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        out = str(tmp_path / "cur")
        sinks.write_partitioned_parquet(cur, out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    leaf = os.path.join(out, "ingest_year=2026", "ingest_month=1")
    files = [f for f in os.listdir(leaf) if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(out).count() == 15000


def test_scan_reads_only_needed_columns(spark):
    """P7: the scaling query prunes the orders scan to the columns it uses."""
    p = plan(catalog.QUERIES["scaling_query"](spark, SF_CHECK))
    read = [line for line in p.splitlines() if "ReadSchema" in line or "FileScan" in line][0]
    assert "o_totalprice" not in read and "o_orderstatus" not in read


def test_filter_pushed_into_parquet_scan(spark):
    df = table(spark, SF_CHECK, "lineitem").where(F.col("l_quantity") > 10).select("l_orderkey")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p


def test_partition_pruning_on_curated_layout(spark, tmp_path):
    """P9: a filter on the partition column prunes directories."""
    cur = cu.curate(fx2(spark, SF_CHECK).select(*FX2_SOURCE_COLUMNS, "event_ts"),
                    columns=FX2_SOURCE_COLUMNS, time_col="event_ts")
    out = str(tmp_path / "cur")
    sinks.write_partitioned_parquet(cur, out)
    q = spark.read.parquet(out).where("ingest_year = 1995 AND ingest_month = 3")
    assert "PartitionFilters: [isnotnull(ingest_year" in plan(q)
    assert q.count() > 0


def test_profiles_are_single_aggregations(spark):
    """P11: one partial + one final aggregate for all columns, no per-column jobs."""
    p = plan(pr.null_profile(fx2(spark, SF_CHECK)))
    assert p.count("HashAggregate") == 2
    p = plan(pr.column_inventory(table(spark, SF_CHECK, "orders")))
    assert p.count("ObjectHashAggregate") + p.count("HashAggregate") == 2


def test_top_values_have_no_text_as_shuffle_key(spark):
    """Counts are keyed by digest; the limit is applied before the values are ranked."""
    from tabqual.operators import frequent
    docs = table(spark, SF_CHECK, "documents")
    p = plan(pr.top_values(docs))
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", p)
    assert keys and all(set(re.findall(r"[a-z_]+(?=#)", k)) <= {"col", "digest"} for k in keys)
    assert "WindowGroupLimit" in p
    p = plan(frequent._by_digest(frequent._long(docs, {0: "text"})))
    assert "hashpartitioning(col" in p and "SortAggregate" not in p


def test_split_has_no_single_partition_exchange(spark):
    o = table(spark, SF_CHECK, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("label"))
    p = plan(sp.stratified_split(o, "label", ["o_orderdate", "o_orderkey"]))
    assert "SinglePartition" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_no_cartesian_products_in_catalog_plans(spark):
    for name in ("auc_ranksum", "model_score_mart", "quality_band_distribution", "null_ratio_fixed"):
        p = plan(catalog.QUERIES[name](spark, SF_CHECK))
        assert "CartesianProduct" not in p, name


def test_split_sorts_a_class_in_several_tasks(spark):
    """The order within a class is cut into ranges: no window has the class alone as its key."""
    o = table(spark, SF_CHECK, "orders").select("o_orderkey", "o_orderdate", F.lit("one").alias("label"))
    p = plan(sp.stratified_split(o, "label", ["o_orderdate", "o_orderkey"]))
    assert "hashpartitioning(_bucket" in p


def test_exact_inventory_copies_no_rows(spark):
    p = plan(pr.column_inventory(table(spark, SF_CHECK, "orders"), exact=True))
    assert "Expand" not in p


def test_fixed_average_scans_its_source_once(spark):
    p = plan(catalog.QUERIES["null_ratio_fixed"](spark, SF_CHECK))
    assert p.count("FileScan parquet") == 2  # documents and labels, once each


def test_wide_frames_come_back_whole(spark):
    wide = spark.range(3).select(*[F.col("id").cast("string").alias(f"s{i}") for i in range(25)],
                                 *[(F.col("id") + i).alias(f"n{i}") for i in range(65)])
    assert pr.numeric_statistics(wide).count() == 65
    assert pr.top_values(wide, k=1).select("column").distinct().count() == 25


def test_merge_join_deals_bands_out_by_salt(spark):
    p = plan(cu.curate(fx2(spark, SF_CHECK).select(*FX2_SOURCE_COLUMNS), run_ts=catalog.RUN_TS, strategy="merge"))
    assert "SortMergeJoin" in p and "_salt" in p


def test_shared_folder_is_required_off_local_masters():
    import pytest
    from types import SimpleNamespace
    from tabqual.session import ensure_checkpoint_dir
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None,
                              getConf=lambda: SimpleNamespace(get=lambda k: None))
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(session)
