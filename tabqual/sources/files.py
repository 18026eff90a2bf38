"""Files as rows: a folder's listing and bounded byte ranges of its files, read inside Spark tasks; one file written by many.

The listing is a Python data source. Its partitions are numbered slices of the folder: a task walks the folder, one directory at a
time, and keeps the files whose path hashes to its slice, so the driver never holds paths. Files are opened through
``pyarrow.fs``, which knows local and shared folders, HDFS and the common object stores.
"""

from __future__ import annotations

import bisect
import itertools
import os
import re
import sys
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tabqual.operators.ranking import ordered_cumulative
from tabqual.session import materialize, shuffle_partitions

# tasks get this module's code with the job, so that executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a range that one task reads at once.
RANGE_BYTES = 8 << 20
LISTING_SCHEMA = "path string, length bigint"
#: Bytes of a file that one task writes.
PART_BYTES = 16 << 20


def open_location(path: str):
    """``(file system, path in it, prefix)``; prefix and path make a location that can be opened again."""
    from pyarrow import fs
    local = re.match(r"file:/*(?=/)", path)
    if local:
        return fs.LocalFileSystem(), path[local.end():], "file://"
    if "://" not in path:
        return fs.LocalFileSystem(), path, ""
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path[:path.index("://") + 3] if not inner.startswith("/") else path[:path.index(inner)]


def walk(path: str) -> Iterator[tuple[str, int]]:
    """``(path, length)`` of the files below ``path``, a directory at a time; names that begin with ``_`` or ``.`` are left out."""
    from pyarrow import fs
    system, root, prefix = open_location(path)
    found = system.get_file_info(root)
    if found.type == fs.FileType.File:
        yield prefix + found.path, found.size
        return
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    left = [root]
    while left:
        for info in system.get_file_info(fs.FileSelector(left.pop())):
            if info.base_name[:1] in ("_", "."):
                continue
            if info.type == fs.FileType.Directory:
                left.append(info.path)
            elif info.type == fs.FileType.File:
                yield prefix + info.path, info.size


def read_bytes(path: str, start: int, size: int) -> bytes:
    """At most ``size`` bytes of the file from ``start`` on."""
    system, inner, _ = open_location(path)
    with system.open_input_file(inner) as f:
        f.seek(start)
        return f.read(size)


def writes_anywhere(path: str) -> bool:
    """Whether tasks can write at any place of one file there: in local and shared folders, not in HDFS or object stores."""
    from pyarrow import fs
    return isinstance(open_location(path)[0], fs.LocalFileSystem)


def write_bytes(path: str, start: int, data: bytes) -> None:
    """Write ``data`` from byte ``start`` of the file on; what else it holds stays."""
    inner = open_location(path)[1]
    os.makedirs(os.path.dirname(inner), exist_ok=True)
    with open(os.open(inner, os.O_WRONLY | os.O_CREAT, 0o666), "wb") as f:
        f.seek(start)
        f.write(data)


class _Slice(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)


class _ListingReader(DataSourceReader):
    def __init__(self, path: str, slices: int):
        self.path, self.slices = path, slices

    def partitions(self):
        return [_Slice(i) for i in range(self.slices)]

    def read(self, partition):
        for path, length in walk(self.path):
            if zlib.crc32(path.encode("utf-8", "surrogatepass")) % self.slices == partition.value:
                yield path, length


class FileListing(DataSource):
    """``spark.read.format("file_listing").load(folder)``: one row for each file; option ``slices``: the number of tasks."""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _ListingReader(self.options["path"], int(self.options.get("slices", "1")))


def list_files(spark: SparkSession, path: str, slices: int | None = None) -> DataFrame:
    """``path, length`` of every file below ``path``, listed by ``slices`` tasks (by default as many as the cluster has cores)."""
    spark.dataSource.register(FileListing)
    return spark.read.format("file_listing").option("slices", slices or spark.sparkContext.defaultParallelism).load(path)


def byte_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES, start: str = "0") -> DataFrame:
    """Cut ``files (path, length)`` from ``start`` on into rows ``path, length, start, stop`` of at most ``range_bytes`` bytes each."""
    cut = files.where(f"{start} < length").selectExpr("*", f"explode(sequence({start}, length - 1, {int(range_bytes)})) AS _at")
    return cut.withColumn("start", F.col("_at")).withColumn("stop", F.expr(f"least(_at + {int(range_bytes)}, length)")).drop("_at")


def dealt(ranges: DataFrame) -> DataFrame:
    """``ranges``, written and dealt out evenly, so that those of one large file go to many tasks.

    The number of tasks is set here, since these few bytes a row stand for megabytes that adaptive execution does not see.
    """
    ranges = materialize(ranges)
    return ranges.repartition(max(1, min(ranges.count(), shuffle_partitions(ranges.sparkSession))))


def map_ranges(ranges: DataFrame, read, schema: str) -> DataFrame:
    """What ``read`` yields for every row, as tuples of ``schema``; one range is held at a time."""
    names = [c.split()[0] for c in schema.split(",")]

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                out = list(read(row))
                if out:
                    yield pd.DataFrame(out, columns=names)

    return ranges.mapInPandas(of_batches, schema)


def write_in_order(lines: DataFrame, path: str, head: bytes, tail: bytes, joint: int = 0, part_bytes: int = PART_BYTES) -> None:
    """Write one file of ``head``, the texts of ``lines (at bigint, value string)`` ascending by ``at`` (null first), and ``tail``.

    The first text loses its first ``joint`` bytes. Texts with the same ``at`` are ordered by their hash. Running sums of the
    lengths cut the texts into parts of about ``part_bytes``, each of which a task of its own writes at its place in the file,
    so a task that runs again writes the same bytes. Only a text, or exact copies of one row, can make a part longer.
    The driver gets two numbers and a length for each part.
    """
    lines = lines.select(F.coalesce("at", F.lit(-1 << 63)).alias("at"), F.xxhash64("value").alias("tie"), F.col("value").cast("binary").alias("value"))
    sizes = materialize(lines.select("at", "tie", F.octet_length("value").cast("bigint").alias("bytes")))
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    buckets = min(-(-total // part_bytes) or 1, shuffle_partitions(lines.sparkSession))
    places = ordered_cumulative(sizes, [], ["at", "tie"], ["bytes"], buckets=buckets)
    parts = (places.groupBy(F.expr(f"(bytes_cum - 1) div {int(part_bytes)}")).agg(F.min(F.struct("at", "tie")).alias("low"), F.sum("bytes").alias("bytes"))
                   .orderBy("low").collect())
    lows = [tuple(p["low"]) for p in parts]
    starts = list(itertools.accumulate((p["bytes"] for p in parts), initial=len(head) - joint))

    @F.pandas_udf("int")
    def part_of(at: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(lows, k) - 1 for k in zip(at.tolist(), tie.tolist())], dtype="int32")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {}
        for batch in batches:
            for part, run in itertools.groupby(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), key=lambda r: r[0]):
                data = b"".join(value for _, value in run)
                at = place.get(part, starts[part])
                skip = joint if at == starts[0] else 0
                write_bytes(path, at + skip, data[skip:])
                place[part] = at + len(data)
        for part, end in place.items():
            if end != starts[part + 1]:
                raise ValueError(f"part {part} of {path} has other rows than when it was measured")
            yield pa.RecordBatch.from_pydict({"bytes": [end - starts[part]]}, schema=pa.schema([("bytes", pa.int64())]))

    write_bytes(path, 0, head)
    if parts:
        dealt_out = lines.withColumn("part", part_of("at", "tie")).repartitionById(len(parts), "part").sortWithinPartitions("part", "at", "tie")
        written = dealt_out.select("part", "value").mapInArrow(write, "bytes bigint").agg(F.sum("bytes")).first()[0]
        if written != total:
            raise ValueError(f"{written} bytes of {total} are in {path}")
    write_bytes(path, len(head) if not parts else starts[-1], tail)
