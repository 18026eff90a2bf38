"""Records of large JSON documents, found by a structural scan of byte ranges, so that many tasks read one document.

A range alone does not tell whether it begins within a string, nor how deep. The first scan counts, for every range, its quotes and
the change of bracket depth under both beginnings; sums over the ranges before it then settle the beginning of each. A second scan,
of documents that are objects, finds where the wrapping array begins and ends. The last scan cuts the records out: a
record belongs to the range that it begins in, and is read to its end wherever that is.

Records are written as JSON lines, which Spark's own reader infers, parses and splits. Brackets and quotes are one byte in UTF-8
and no part of other characters. A document is checked as a whole for closed strings and brackets, each record by the parser.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabqual.session import materialize, shared_path
from tabqual.sources import readers as rd
from tabqual.sources.files import byte_ranges, dealt, list_files, map_ranges, read_bytes
from tabqual.sources.sniff import head_facts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a range: a scan holds some ten times as many.
RANGE_BYTES = 4 << 20
_SIGN = np.zeros(256, np.int8)
_SIGN[list(b"{[")] = 1
_SIGN[list(b"}]")] = -1
_QUOTE, _ESCAPE = ord('"'), ord("\\")


def escapes_before(path: str, at: int) -> int:
    """Number of backslashes directly before byte ``at`` of the file."""
    n = size = 0
    while n == size and size < at:
        size = min(at, max(64, 4 * size))
        data = read_bytes(path, at - size, size)
        n = len(data) - len(data.rstrip(b"\\"))
    return n


def open_quotes(data: np.ndarray, escapes: int) -> np.ndarray:
    """Places of the quotes in ``data`` that are not escaped, ``escapes`` backslashes being before it."""
    quotes = np.flatnonzero(data == _QUOTE)
    escaped = np.zeros(len(quotes), bool)
    after = quotes[quotes > 0]
    led = np.flatnonzero(quotes > 0)[data[after - 1] == _ESCAPE]  # quotes with a backslash before them
    if len(led):
        slash = data == _ESCAPE
        runs = np.flatnonzero(slash & ~np.concatenate(([False], slash[:-1])))
        begin = runs[np.searchsorted(runs, quotes[led]) - 1]
        escaped[led] = (quotes[led] - begin + np.where(begin == 0, escapes, 0)) % 2 == 1
    if len(quotes) and quotes[0] == 0:
        escaped[0] = escapes % 2 == 1
    return quotes[~escaped]


def brackets(data: np.ndarray, escapes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places and signs of all brackets, whether an odd number of quotes is before each, and the number of quotes."""
    quotes = open_quotes(data, escapes)
    at = np.flatnonzero(_SIGN[data])
    return at, _SIGN[data[at]].astype(np.int64), np.searchsorted(quotes, at) % 2 == 1, len(quotes)


def _summary(path: str, start: int, stop: int) -> tuple:
    _, sign, odd, quotes = brackets(np.frombuffer(read_bytes(path, start, stop - start), np.uint8), escapes_before(path, start))
    return path, start, stop, quotes, int(sign[~odd].sum()), int(sign[odd].sum())


class _Walk:
    """The structure of a range whose beginning is known: brackets outside strings and the depth before each."""

    def __init__(self, path: str, start: int, stop: int, inside: bool, depth: int):
        self.path, self.start, self.stop = path, start, stop
        self.bytes = read_bytes(path, start, stop - start)
        data = np.frombuffer(self.bytes, np.uint8)
        at, sign, odd, quotes = brackets(data, escapes_before(path, start))
        structural = odd == inside
        self.at, sign = at[structural], sign[structural]
        self.char = data[self.at]
        self.after = depth + np.cumsum(sign)
        self.before = self.after - sign
        self.end_inside, self.end_depth = inside ^ (quotes % 2 == 1), int(self.after[-1]) if len(sign) else depth


def _key_ends_with(path: str, at: int, key: bytes) -> bool:
    """Whether ``"key" :`` stands before byte ``at``."""
    size = 0
    while True:
        size = min(at, max(256, 4 * size))
        text = read_bytes(path, at - size, size).rstrip()
        text = text[:-1].rstrip() if text.endswith(b":") else text
        if len(text) > len(key) + 2 or size == at:
            return text.endswith(b'"' + key + b'"') and not text.endswith(b'\\"' + key + b'"')


def _wrapping(row, key: bytes) -> Iterator[tuple]:
    """``(path, place, opens)``: where an array under ``key`` opens in the outermost object, and where any member of it closes."""
    w = _Walk(row.path, row.start, row.stop, row.inside, row.depth)
    for i in np.flatnonzero((w.before == 1) & (w.char == ord("["))):
        if _key_ends_with(row.path, row.start + int(w.at[i]), key):
            yield row.path, row.start + int(w.at[i]), True
    for i in np.flatnonzero((w.after == 1) & (w.char == ord("]"))):
        yield row.path, row.start + int(w.at[i]), False


def _records(row) -> Iterator[tuple]:
    """``(value, whole)``: the records that begin in a range, on one line each."""
    w = _Walk(row.path, row.start, row.stop, row.inside, row.depth)
    place = w.at + row.start
    begins = w.at[(w.before == row.level) & (w.char == ord("{")) & (place > row.opened) & (place < row.closed)]
    ends = w.at[(w.after == row.level) & (w.char == ord("}"))]
    for begin in begins:
        i = np.searchsorted(ends, begin)
        text = w.bytes[begin:ends[i] + 1] if i < len(ends) else w.bytes[begin:] + _rest(w, row)
        yield text.replace(b"\n", b" ").replace(b"\r", b" ").decode("utf-8", "replace"), row.level == 0


def _rest(w: _Walk, row) -> bytes:
    """What follows the range up to the end of the record that goes on there."""
    parts = []
    while w.stop < row.length:
        w = _Walk(w.path, w.stop, min(w.stop + max(w.stop - w.start, 1 << 16), row.length), w.end_inside, w.end_depth)
        ends = w.at[(w.after == row.level) & (w.char == ord("}"))]
        if len(ends):
            return b"".join(parts) + w.bytes[:ends[0] + 1]
        parts.append(w.bytes)
    return b"".join(parts)


def document_records(spark: SparkSession, path: str, wrapper: str, range_bytes: int = RANGE_BYTES, slices: int | None = None) -> DataFrame:
    """``value, whole``: the text of every record of the JSON documents below ``path`` (one document to a file), on one line.

    Records are the objects of a top-level array, or of the arrays under ``wrapper`` in a top-level object. A top-level object
    without such an array is a record of its own (``whole``). Elements that are no objects are no records. A file without a JSON
    value, or with an open string or bracket at its end, is an error; blank files have no records.
    """
    if range_bytes < 1:
        raise ValueError("a range has one byte at least")
    listed = materialize(list_files(spark, path, slices))
    heads = map_ranges(dealt(listed), lambda r: [(r.path, head_facts(r.path, r.length, 4096)[5])], "path string, opens string")
    files = materialize(listed.join(heads, "path").where("opens IS NOT NULL"))
    summary = materialize(map_ranges(dealt(byte_ranges(files, range_bytes)), lambda r: [_summary(r.path, r.start, r.stop)],
                                     "path string, start bigint, stop bigint, quotes bigint, outer bigint, inner bigint"))
    # windows over one row for each range of a file
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = summary.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier) % 2 == 1, F.lit(False)))
    known = known.withColumn("change", F.when(F.col("inside"), F.col("inner")).otherwise(F.col("outer")))
    known = materialize(known.withColumn("depth", F.coalesce(F.sum("change").over(earlier), F.lit(0))))
    whole = known.groupBy("path").agg(F.sum("change").alias("depth"), (F.sum("quotes") % 2).alias("open"))
    bad = files.join(whole, "path").where("depth <> 0 OR open <> 0 OR opens NOT IN ('{', '[')").select("path").limit(1).collect()
    if bad:
        raise rd.SourceError(f"not valid JSON: {bad[0]['path']}")
    ranges = known.join(files, "path")
    key = wrapper.encode()
    marks = materialize(map_ranges(dealt(ranges.where("opens = '{'")), lambda r: _wrapping(r, key), "path string, place bigint, opens boolean"))
    closing = marks.where("NOT opens").select("path", F.col("place").alias("closed"))
    arrays = (marks.where("opens").select("path", F.col("place").alias("opened")).join(closing, "path").where("closed > opened")
                   .groupBy("path", "opened").agg(F.min("closed").alias("closed")))
    level = F.when(F.col("opens") == "[", 1).when(F.col("opened").isNotNull(), 2).otherwise(0)
    ranges = ranges.join(arrays, "path", "left").withColumn("level", level)
    ranges = ranges.withColumns({"opened": F.coalesce("opened", F.lit(-1)), "closed": F.coalesce("closed", "length")})
    return map_ranges(dealt(ranges.where("stop > opened AND start < closed")), _records, "value string, whole boolean")


def _lines(spark: SparkSession, path: str, wrapper: str, **bounds) -> tuple[DataFrame | None, str | None]:
    """The parsed records of arrays (None without any), and the folder of documents that are records themselves."""
    out = shared_path(spark, "json-records")
    document_records(spark, path, wrapper, **bounds).write.partitionBy("whole").option("compression", "gzip").text(out)
    kinds = {r["kind"] for r in list_files(spark, out, 1).selectExpr("regexp_extract(path, 'whole=(true|false)', 1) AS kind").distinct().collect()}
    parsed = rd._strict_json(spark, f"{out}/whole=false", False) if "false" in kinds else None
    return parsed, f"{out}/whole=true" if "true" in kinds else None


def read_large_geojson(spark: SparkSession, path: str, **bounds) -> DataFrame:
    """The rows of :func:`readers.read_geojson` for documents of any size; the ranges of one document go to many tasks."""
    features, singles = _lines(spark, path, "features", **bounds)
    parts = []
    if features is not None:
        parts.append(rd.flatten_feature_rows(features.select(F.struct(*features.columns).alias("f"))))
    if singles is not None:
        parts.append(rd.read_geojson(spark, singles, multiline=False))
    if not parts:
        return spark.createDataFrame([], "geometry_type string")
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return out.select(*[c for c in out.columns if c != "geometry_type"], "geometry_type")


def read_large_json(spark: SparkSession, path: str, wrapper: str = "results", **bounds) -> DataFrame:
    """The rows of :func:`readers.read_wrapped_json` for documents of any size; the ranges of one document go to many tasks."""
    rows, singles = _lines(spark, path, wrapper, **bounds)
    if singles is not None:
        raise rd.SourceError(f"a JSON document must be an array of objects or hold '{wrapper}'")
    if rows is None:
        raise rd.SourceError("JSON input holds no parsable records")
    return rows
