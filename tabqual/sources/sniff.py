"""Format decisions from a bounded head of each file, and from byte ranges of the rest where the head does not decide.

The decision is that of ``readers.format_expr``: a marker of a collection may sit anywhere in a file. A task reads the first
``head_bytes`` of a file, and none of a file that its name decides. Where the head holds no marker, the rest is cut into byte ranges
that many tasks look through; no file is held whole, and a large one is not one task's work.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabqual.session import materialize
from tabqual.sources.files import RANGE_BYTES, byte_ranges, dealt, list_files, map_ranges, read_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEAD_BYTES = 64 << 10
# The markers of a collection, and white space.
COLLECTION, TYPE = b"FeatureCollection", b'"type"'
_BLANK = b" \t\n\x0b\x0c\r"
#: Bytes before a range that a marker across its border may begin in.
OVERLAP = len(COLLECTION) - 1
_FACTS = "path string, start bigint, bytes_read bigint, collection boolean, typed boolean, opens string, line_end bigint, comma bigint, tail string"


def _line_facts(data: bytes, begin: int, start: int) -> tuple:
    """Places (in the file) of the first line end and comma in ``data[begin:]``, and the last byte before that end, spaces aside."""
    ends = [i for i in (data.find(b"\n", begin), data.find(b"\r", begin)) if i >= 0]
    end = min(ends) if ends else len(data)
    comma = data.find(b",", begin, end)
    tail = data[begin:end].rstrip(b" ")[-1:].decode("latin-1")
    return start + end if ends else None, start + comma if comma >= 0 else None, tail or None


def head_facts(path: str, length: int, head_bytes: int) -> tuple:
    """What the head of a file tells: markers, its first character, and the first line as far as the head goes.

    Blank bytes before the first character are passed block by block, however many there are.
    """
    at, read, collection, typed, kept = 0, 0, False, False, b""
    while at < length:
        block = read_bytes(path, at, head_bytes)
        read += len(block)
        seen = kept[-OVERLAP:] + block
        collection, typed = collection or COLLECTION in seen, typed or TYPE in seen
        begin = len(block) - len(block.lstrip(_BLANK))
        if begin < len(block) or not block:
            facts = _line_facts(block, begin, at)
            return path, at + len(block), read, collection, typed, block[begin:begin + 1].decode("latin-1") or None, *facts
        at, kept = at + len(block), block
    return path, length, read, collection, typed, None, None, None, None


def range_facts(path: str, start: int, stop: int) -> tuple:
    """What a range after the head tells: markers (also across its first byte) and the first line, if it goes on here."""
    before = min(start, OVERLAP)
    data = read_bytes(path, start - before, stop - start + before)
    return path, start, len(data), COLLECTION in data, TYPE in data, None, *_line_facts(data, before, start - before)


def sniff(spark: SparkSession, path: str, head_bytes: int = HEAD_BYTES, range_bytes: int = RANGE_BYTES, slices: int | None = None) -> DataFrame:
    """``path, length, bytes_read, format, json_layout`` for every file below ``path``.

    Formats: ``csv``, ``geojson``, ``json``, ``empty``, ``unknown``. ``json_layout`` is ``lines`` where the first line of a JSON file
    holds one whole object, else ``document``, and NULL for other formats. ``bytes_read`` tells how much of the file was looked at.
    A folder without files gives no rows; a path that does not exist is an error.
    """
    if min(head_bytes, range_bytes) < 1:
        raise ValueError("a head and a range have one byte at least")
    name = F.lower("path")
    named = F.when(F.col("length") == 0, "empty").when(name.endswith(".csv"), "csv").when(name.endswith(".geojson"), "geojson")
    files = materialize(list_files(spark, path, slices).withColumn("named", named))
    heads = materialize(map_ranges(dealt(files.where("named IS NULL")), lambda r: [head_facts(r.path, r.length, head_bytes)], _FACTS))
    # the first line ends in the head or goes on; markers are looked for to the end of the file
    open_end = heads.where("NOT (collection AND typed) AND opens IS NOT NULL").selectExpr("path", "start AS head_end")
    rest = dealt(byte_ranges(files.join(open_end, "path"), range_bytes, "head_end"))
    ranges = map_ranges(rest, lambda r: [range_facts(r.path, r.start, r.stop)], _FACTS)
    facts = heads.withColumn("start", F.lit(-1).cast("bigint")).unionByName(ranges)
    # one row for each range of a file; what follows the first line end does not matter to the first line
    facts = facts.withColumn("end", F.min("line_end").over(Window.partitionBy("path")))
    tail = F.when(F.col("end").isNull() | (F.col("start") <= F.col("end")), F.col("tail"))
    facts = facts.groupBy("path").agg(
        F.sum("bytes_read").alias("bytes_read"), (F.max("collection") & F.max("typed")).alias("collection"), F.max("opens").alias("opens"),
        F.min("end").alias("line_end"), F.min("comma").alias("comma"),
        F.max(F.when(tail.isNotNull(), F.struct("start", tail.alias("tail"))))["tail"].alias("tail"))
    opens_json = F.col("opens").isin("{", "[")
    has_comma = F.col("comma").isNotNull() & (F.col("line_end").isNull() | (F.col("comma") < F.col("line_end")))
    fmt = (F.coalesce(F.col("named"), F.when(F.col("collection"), "geojson").when(name.endswith(".json"), "json")
                      .when(opens_json, "json").when(has_comma, "csv").otherwise("unknown")))
    layout = F.when((F.col("opens") == "{") & (F.col("tail") == "}"), "lines").otherwise("document")
    out = files.join(facts, "path", "left").withColumn("format", fmt)
    return out.select("path", "length", F.coalesce("bytes_read", F.lit(0)).cast("bigint").alias("bytes_read"), "format",
                      F.when(F.col("format") == "json", layout).alias("json_layout"))
