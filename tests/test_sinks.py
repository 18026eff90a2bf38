"""Sinks: dynamic partition overwrite, report CSV, lineage."""

from pyspark.sql import functions as F

from tabqual.sources import sinks


def test_overwrite_replaces_only_present_partitions(spark, tmp_path):
    out = str(tmp_path / "t")
    a = spark.range(10).select(F.lit(2024).alias("ingest_year"), (F.col("id") % 2 + 1).alias("ingest_month"), "id")
    sinks.write_partitioned_parquet(a, out)
    b = spark.range(3).select(F.lit(2024).alias("ingest_year"), F.lit(1).alias("ingest_month"),
                              (F.col("id") + 100).alias("id"))
    sinks.write_partitioned_parquet(b, out)
    got = {r["ingest_month"]: r["count"] for r in spark.read.parquet(out).groupBy("ingest_month").count().collect()}
    assert got == {1: 3, 2: 5}


def test_report_csv_single_part_with_header(spark, tmp_path):
    out = str(tmp_path / "r")
    sinks.write_report_csv(spark.range(5).withColumn("x", F.lit("a,b")), out, quote_all=True)
    parts = [p for p in (tmp_path / "r").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 1
    text = parts[0].read_text()
    assert text.splitlines()[0] == '"id","x"' and '"a,b"' in text


def test_lineage_append_and_status(spark, tmp_path):
    path = str(tmp_path / "lineage")
    sinks.log_lineage(spark, path, "r1", "read", "ok", {"rows": 5})
    sinks.log_lineage(spark, path, "r1", "write", "error", {"message": "disk"})
    sinks.log_lineage(spark, path, "r2", "read", "ok")
    st = {r["run_id"]: (r["steps"], r["failed_steps"]) for r in sinks.lineage_status(sinks.read_lineage(spark, path)).collect()}
    assert st == {"r1": (2, 1), "r2": (1, 0)}


def test_scale_conf_follows_input_size(spark):
    from tabqual.session import TARGET_PARTITION_BYTES, input_bytes, scale_conf
    small = scale_conf(10 * 1024 * 1024, 8)
    big = scale_conf(100 * 1024 ** 4, 8000)          # 100 TB on 8000 cores
    assert small["spark.sql.shuffle.partitions"] == "24"
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // TARGET_PARTITION_BYTES
    assert input_bytes(spark, "/root/testdata/sf0.01/lineitem.parquet") > 1_000_000


def test_a_repeated_lineage_write_adds_nothing_and_the_last_whole_attempt_counts(spark, tmp_path):
    path = str(tmp_path / "lineage")
    for _ in range(2):
        sinks.log_lineage(spark, path, "12", "write step", "error", {"message": "x"})
    sinks.log_lineage(spark, path, "12", "write step", "ok", attempt=1)
    sinks.log_lineage(spark, path, "12", "write step", "error")  # comes in late
    got = sinks.read_lineage(spark, path).collect()
    assert [(r["run_id"], r["step"], r["status"], r["attempt"]) for r in got] == [("12", "write step", "ok", 1)]
    two = sinks.lineage_record(spark, "12", "write step", "ok").unionByName(sinks.lineage_record(spark, "12", "write step", "error"))
    sinks.upsert_lineage(two, path, attempt=2)
    assert sinks.lineage_status(sinks.read_lineage(spark, path)).first()[:3] == ("12", 1, 1)
    lost = two.limit(1).selectExpr("status", "timestamp_utc", "details", "2L AS records", "run_id", "step", "3 AS attempt")
    lost.write.mode("append").partitionBy("run_id", "step", "attempt").parquet(path)  # one record of two
    assert {r["attempt"] for r in sinks.read_lineage(spark, path).collect()} == {2}
