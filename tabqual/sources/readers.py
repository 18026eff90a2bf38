"""Source readers: CSV, JSON lines, GeoJSON, wrapped JSON, corrupt-record split,
format sniffing and resource ranking.

Everything is a Spark reader or a column expression; no file is parsed on the
driver. Multi-line JSON documents (a GeoJSON FeatureCollection, a top-level
array) are read one task per file, so large inputs should come as many files
or as one JSON document per line, which Spark splits freely.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabqual.functions.columns import quote
from tabqual.session import materialize
from tabqual.sources.sniff import sniff

CORRUPT_COLUMN = "_corrupt_record"

# Resource ranks by format (lower is preferred; unknown formats rank last).
RANK_CSV, RANK_GEOJSON, RANK_JSON, RANK_OTHER = 0, 1, 2, 9


class SourceError(ValueError):
    pass


# --------------------------------------------------------------------------- plain readers

def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             infer: bool = True) -> DataFrame:
    """CSV with a header row; types inferred unless a schema is given (one pass fewer)."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_json_lines(spark: SparkSession, path: str | Sequence[str],
                    schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet with partition discovery (``key=value`` folders become columns)."""
    return spark.read.parquet(*([path] if isinstance(path, str) else list(path)))


# --------------------------------------------------------------------------- GeoJSON / wrapped JSON

def flatten_features(collections: DataFrame, features_col: str = "features") -> DataFrame:
    """One row per feature: its ``properties`` fields plus ``geometry_type``.

    A property named ``geometry_type`` is replaced by the geometry's type;
    NULL properties give a row with only ``geometry_type``; NULL geometry gives
    a NULL type; a collection without ``features`` gives no rows.
    """
    if features_col not in collections.columns:
        return collections.sparkSession.createDataFrame([], "geometry_type string")
    feats = collections.select(F.explode(features_col).alias("f"))
    return flatten_feature_rows(feats, "f")


def flatten_feature_rows(feats: DataFrame, col: str = "f") -> DataFrame:
    ftype = feats.schema[col].dataType
    names = {f.name: f.dataType for f in ftype.fields} if isinstance(ftype, T.StructType) else {}
    props = []
    if "properties" in names and isinstance(names["properties"], T.StructType):
        props = [F.col(f"{col}.properties").getField(p.name).alias(p.name)
                 for p in names["properties"].fields if p.name != "geometry_type"]
    geom = names.get("geometry")
    if isinstance(geom, T.StructType) and "type" in geom.fieldNames():
        gtype = F.col(f"{col}.geometry.type").cast("string")
    else:
        gtype = F.lit(None).cast("string")
    return feats.select(*props, gtype.alias("geometry_type"))


def read_geojson(spark: SparkSession, path: str | Sequence[str], multiline: bool = True) -> DataFrame:
    """GeoJSON FeatureCollections -> one row per feature.

    ``multiline=True`` reads standard pretty-printed files (one task per
    file); ``False`` reads one FeatureCollection or one Feature per line, mixed freely.
    A document that is not JSON is an error.
    """
    raw = _strict_json(spark, path, multiline)
    parts = []
    if "features" in raw.columns:
        parts.append(flatten_features(raw.where(F.col("features").isNotNull()), "features"))
    if "properties" in raw.columns or "geometry" in raw.columns:  # documents that are Features themselves
        own = [c for c in raw.columns if c != "features"]
        rows = raw.where(F.col("features").isNull()) if "features" in raw.columns else raw
        rows = rows.where(F.col("type") == "Feature") if "type" in raw.columns else rows
        parts.append(flatten_feature_rows(rows.select(F.struct(*own).alias("f")), "f"))
    if not parts:
        return spark.createDataFrame([], "geometry_type string")
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return out.select(*[c for c in out.columns if c != "geometry_type"], "geometry_type")


def _strict_json(spark: SparkSession, path: str | Sequence[str], multiline: bool) -> DataFrame:
    """JSON whose schema is inferred from every record; a malformed record is an error, not a NULL row."""
    try:
        return spark.read.option("multiLine", multiline).option("mode", "FAILFAST").json(path)
    except (PySparkException, Py4JJavaError) as e:  # the latter where the job of the inference fails
        raise SourceError(f"not valid JSON: {path}") from e


def unwrap_json(raw: DataFrame, wrapper: str = "results") -> DataFrame:
    """Rows of ``{"<wrapper>": [objects]}`` documents; plain objects (from arrays
    or lines) read in the same pass are kept beside them. A NULL or empty wrapper holds no rows."""
    if raw.columns == [CORRUPT_COLUMN] or not raw.columns:
        raise SourceError("JSON input holds no parsable records")
    if wrapper in raw.columns and isinstance(raw.schema[wrapper].dataType, T.ArrayType):
        elem = raw.schema[wrapper].dataType.elementType
        if not isinstance(elem, T.StructType):
            raise SourceError(f"'{wrapper}' does not hold objects")
        unwrapped = raw.where(F.col(wrapper).isNotNull()).select(F.explode(wrapper).alias("r")).select("r.*")
        others = [c for c in raw.columns if c != wrapper]
        if others:
            something = F.greatest(F.lit(False), *[F.col(quote(c)).isNotNull() for c in others], F.lit(False))
            plain = raw.where(F.col(wrapper).isNull() & something).select(*[F.col(quote(c)) for c in others])
            unwrapped = unwrapped.unionByName(plain, allowMissingColumns=True)
        return unwrapped
    return raw


def read_wrapped_json(spark: SparkSession, path: str | Sequence[str], wrapper: str = "results",
                      multiline: bool = True) -> DataFrame:
    """Top-level array of objects, or ``{"results": [...]}``; anything else is an error.

    Spark reads a top-level array as one row per element natively. By line
    (``multiline=False``), an object without the wrapper is a record of its own.
    """
    raw = _strict_json(spark, path, multiline)
    if multiline:
        # an object and a one-element array parse alike: tell them apart by the text of each document
        text = F.regexp_replace("value", r"^[\s\x{FEFF}]+", "")
        lone = F.get_json_object(text, f"$.{wrapper}").isNull() & ~text.startswith("[")
        if not spark.read.text(path, wholetext=True).where(lone & (F.length(text) > 0)).limit(1).isEmpty():
            raise SourceError(f"a JSON document must be an array of objects or hold '{wrapper}'")
    return unwrap_json(raw, wrapper)


# --------------------------------------------------------------------------- corrupt records

def read_with_quarantine(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                         fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    """PERMISSIVE parse split into (good rows, quarantined raw records): two filters of :func:`parse_lines`."""
    raw = parse_lines(spark, path, schema, fmt)
    good = raw.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    bad = raw.where(F.col(CORRUPT_COLUMN).isNotNull())
    return good, bad


def parse_lines(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, fmt: str = "json") -> DataFrame:
    """The fields of every record, and in ``_corrupt_record`` the raw text of those that do not parse.

    Lines are read as text and parsed with ``from_json`` / ``from_csv`` in one splittable scan. Blank lines are no
    records; a line that parses to no struct at all is corrupt. CSV input must not have a header line.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*$"))
    if fmt == "json":
        parsed = lines.select("value", F.from_json("value", full, options).alias("r"))
    elif fmt == "csv":
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
        parsed = lines.select("value", F.from_csv("value", ddl, options).alias("r"))
    else:
        raise SourceError(f"unsupported format {fmt!r}")
    broken = F.when(F.col("r").isNull(), F.col("value")).otherwise(F.col(f"r.{CORRUPT_COLUMN}"))
    return parsed.select(*[F.col("r").getField(f.name).alias(f.name) for f in schema.fields], broken.alias(CORRUPT_COLUMN))


# --------------------------------------------------------------------------- format sniffing

def _sniff_text(content: Column, text: bool = False) -> Column:
    """The whole content without leading whitespace: a marker may sit anywhere in it."""
    return F.regexp_replace(content if text else content.cast("binary").cast("string"), r"^\s+", "")


def format_expr(path: Column, content: Column, content_type: Column | None = None,
                text: bool = False) -> Column:
    """``csv`` / ``geojson`` / ``json`` / ``empty`` / ``unknown`` from name, content type, then content.

    Order: a ``.csv`` name or ``text/csv`` type; a ``.geojson`` name,
    ``geo+json`` type, or content holding both ``FeatureCollection`` and
    ``"type"``; a ``.json`` name or ``application/json`` type; a first line
    with a comma that does not open a JSON value; content that opens one. The rest is unknown.
    """
    name = F.lower(path)
    ctype = F.lower(F.coalesce(content_type, F.lit(""))) if content_type is not None else F.lit("")
    sample = _sniff_text(content, text)
    first_line = F.regexp_extract(sample, r"^([^\r\n]*)", 1)
    opens_json = first_line.startswith("{") | first_line.startswith("[")
    return (F.when(F.coalesce(F.length(content.cast("binary")), F.lit(0)) == 0, F.lit("empty"))
             .when(name.endswith(".csv") | ctype.contains("text/csv"), F.lit("csv"))
             .when(name.endswith(".geojson") | ctype.contains("geo+json")
                   | (sample.contains("FeatureCollection") & sample.contains('"type"')), F.lit("geojson"))
             .when(name.endswith(".json") | ctype.contains("application/json"), F.lit("json"))
             .when(first_line.contains(",") & ~opens_json, F.lit("csv"))
             .when(opens_json, F.lit("json"))
             .otherwise(F.lit("unknown")))


def detect_formats(spark: SparkSession, path: str, **bounds) -> DataFrame:
    """``path, length, bytes_read, format, json_layout`` for every file below ``path``, a written table; see :func:`sniff.sniff`."""
    return materialize(sniff(spark, path, **bounds))


def read_detected(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Read every file with the reader its detected format asks for and union
    the results by name (missing columns become NULL).

    ``files`` is the per-file table from :func:`detect_formats`. Only the locations
    that a reader has to open reach the driver, once. JSON lines are read line by line (split
    freely), JSON documents one per task; for large ones see :mod:`tabqual.sources.structural`.
    """
    bad = files.where(F.col("format").isin("empty", "unknown")).select("path", "format").limit(1).collect()
    if bad:
        raise SourceError(f"{bad[0]['format']} source file: {bad[0]['path']}")
    readers = {("csv", None): lambda p: read_csv(spark, p), ("geojson", None): lambda p: read_geojson(spark, p),
               ("json", "lines"): lambda p: read_wrapped_json(spark, p, multiline=False),
               ("json", "document"): lambda p: read_wrapped_json(spark, p)}
    groups = files.groupBy("format", "json_layout").agg(F.collect_list("path").alias("paths")).collect()
    found = {(r["format"], r["json_layout"]): r["paths"] for r in groups}
    parts = [read(found[kind]) for kind, read in readers.items() if kind in found]
    if not parts:
        raise SourceError("no readable files")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


# --------------------------------------------------------------------------- resource ranking

def resource_rank_expr(fmt: Column, url: Column) -> Column:
    f, u = F.lower(F.coalesce(fmt, F.lit(""))), F.lower(F.coalesce(url, F.lit("")))
    return (F.when(f.contains("csv") | u.endswith(".csv"), F.lit(RANK_CSV))
             .when(f.contains("geojson") | u.contains("geojson"), F.lit(RANK_GEOJSON))
             .when(f.contains("json") | u.endswith(".json"), F.lit(RANK_JSON))
             .otherwise(F.lit(RANK_OTHER)))


def best_resource(catalog: DataFrame, dataset_col: str = "dataset", format_col: str = "format",
                  url_col: str = "url", ordinal_col: str = "ordinal") -> DataFrame:
    """Preferred resource per dataset: lowest rank, first listed on ties.

    A min over a (rank, ordinal, url) struct is a plain aggregate, so a
    dataset with very many resources is reduced map-side before the shuffle.
    """
    ranked = catalog.select(
        dataset_col,
        F.struct(resource_rank_expr(F.col(format_col), F.col(url_col)).alias("rank"),
                 F.col(ordinal_col).alias("ordinal"), F.col(url_col).alias("url")).alias("r"))
    best = ranked.groupBy(dataset_col).agg(F.min("r").alias("r"))
    return best.select(dataset_col, F.col("r.url").alias(url_col), F.col("r.rank").alias("rank"),
                       F.col("r.ordinal").alias(ordinal_col))
