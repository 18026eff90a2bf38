"""Session construction and the shared working folder.

Cluster jobs write intermediate tables only below the shared folder named by
``spark.checkpoint.dir``. A private folder is created only when that setting
is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def get_session(master: str | None = None, app_name: str = "tabqual",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and no UI."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_private: list[tempfile.TemporaryDirectory] = []

# Target bytes per task for scans and shuffles, and the largest
# side the planner may broadcast after measuring it at runtime.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings sized for an input of ``input_bytes`` on ``total_cores`` cores.

    Initial shuffle partitions follow the data (about 128 MB each, at least
    three waves of tasks); adaptive execution coalesces small partitions and
    splits skewed ones at runtime, so the initial number errs on the high side.
    """
    parts = max(3 * total_cores, -(-int(input_bytes) // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(MAX_BROADCAST_BYTES),
    }


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files behind ``paths`` (file lengths only; no content is read)."""
    from pyspark.sql import functions as F
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(*([paths] if isinstance(paths, str) else list(paths))))
    return int(files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def apply_scale_conf(spark: SparkSession, paths, total_cores: int | None = None) -> dict[str, str]:
    """Size the session for the parquet input at ``paths``; returns what was set."""
    cores = total_cores or spark.sparkContext.defaultParallelism
    conf = scale_conf(input_bytes(spark, paths), cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Where the setting is absent, a private folder serves a ``local`` master (it is removed when Python
    ends); any other master is an error, since executors could not read one another's files.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    _private.append(tempfile.TemporaryDirectory(prefix="tabqual-ckpt-", ignore_cleanup_errors=True))
    local = _private[-1].name
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder for a written table."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "tabqual", f"{name}-{uuid.uuid4().hex[:12]}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df):
    """Write ``df`` as Parquet below the shared folder and read it back, which cuts its lineage.

    Used for derived tables that several later passes read, so their
    (possibly expensive) inputs are computed once and survive lost executors.
    """
    path = shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
