"""Written tables in the cluster's shared folder, and small reading helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabqual.session import ensure_checkpoint_dir

_shipped: dict[str, str] = {}


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    The written table cuts the lineage and can be read again after an executor is lost.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabqual-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(id_col: str, mod: int) -> Column:
    """``crc32`` of the id as text, modulo ``mod``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


#: Most rows of a batch that a Python worker gets at once; rows hold whole texts.
TEXT_BATCH_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this library to the executors' Python workers, once per Spark application, and bound their batches."""
    sc = spark.sparkContext
    if not 0 < int(spark.conf.get(_BATCH_ROWS)) <= TEXT_BATCH_ROWS:
        spark.conf.set(_BATCH_ROWS, str(TEXT_BATCH_ROWS))
    if _shipped.get("to") == sc.applicationId:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="tabqual-py-")  # on the driver only; Spark sends the file itself
    archive = f"{folder}/{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(archive)
    _shipped["to"] = sc.applicationId


def map_pandas(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInPandas`` with this library at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInPandas(fn, schema)
