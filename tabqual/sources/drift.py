"""JSON lines whose fields change from file to file, read without a schema.

Every line is parsed once, to a VARIANT that is stored. The schema of the table is merged from the stored values on the cluster, whatever files
they come from, so a field that some files lack, or that came in late, is kept. A field with types that do not merge (a number here, a text there) is
returned as text, as it was written; lines that are not a JSON object are kept apart.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabqual.functions.columns import quote
from tabqual.session import materialize

_QUOTED_OR_TYPE = re.compile(r"`(?:``|[^`])*`|OBJECT<|(?:(?<=: )|(?<=<))VOID\b(?!:)")


@dataclass
class DriftingTable:
    """Typed rows, the fields whose types do not merge, and the lines that hold no JSON object."""

    rows: DataFrame
    drifted: list[str]
    broken: DataFrame


def _merged_type(values: DataFrame) -> str | None:
    """Type, as DDL, that all objects in column ``v`` merge to; None without an object or field."""
    merged = values.agg(F.expr("schema_of_variant_agg(v)")).first()[0]
    if not merged or not merged.startswith("OBJECT<") or merged == "OBJECT<>":
        return None
    return _QUOTED_OR_TYPE.sub(lambda m: {"OBJECT<": "STRUCT<", "VOID": "STRING"}.get(m[0], m[0]), merged)


def _field(f: T.StructField) -> str:
    if isinstance(f.dataType, T.VariantType):
        # text as it is, anything else as JSON
        path = f"s.{quote(f.name)}"
        return (f"CASE WHEN is_variant_null({path}) THEN NULL WHEN schema_of_variant({path}) = 'STRING' THEN CAST({path} AS STRING) "
                f"ELSE to_json({path}) END AS {quote(f.name)}")
    return f"s.{quote(f.name)}"


def read_drifting_json(spark: SparkSession, path: str | list[str]) -> DriftingTable:
    """The JSON-lines files of a path (or several) as one table with the fields of all of them.

    The files are read once; what follows reads the stored values. Whole numbers of any size merge to one type, with fractions to a decimal or double.
    A JSON null and a missing field are both NULL; a field that is never anything else is a string. Blank lines are left out.
    Types of a field inside of objects and arrays merge too; where they do not, the field inside stays a VARIANT. Without an object there are no columns.
    """
    lines = spark.read.text(path).where("trim(value) <> ''")
    is_object = "coalesce(schema_of_variant(v) LIKE 'OBJECT<%', false)"
    # stored apart, since Spark casts the stored values in the scan, before any filter
    parsed = materialize(lines.select(F.expr("try_parse_json(value) AS v"), "value").selectExpr(
        f"CASE WHEN {is_object} THEN v END AS v", f"CASE WHEN NOT {is_object} THEN value END AS value"))
    objects = parsed.where("v IS NOT NULL").select("v")
    merged = _merged_type(objects)
    if merged is None:
        return DriftingTable(objects.select(), [], parsed.where("value IS NOT NULL").select("value"))
    typed = objects.select(F.expr(f"CAST(v AS {merged}) AS s"))
    fields = typed.schema["s"].dataType.fields
    return DriftingTable(typed.selectExpr(*map(_field, fields)), [f.name for f in fields if isinstance(f.dataType, T.VariantType)],
                         parsed.where("value IS NOT NULL").select("value"))
