"""Small literal tables built inside the JVM.

``createDataFrame`` on a Python list scans a Python RDD, which starts Python
workers when the plan runs; a dimension of a few rows is instead written as
an ``inline`` of literal structs over a one-row range, which Spark evaluates
(and broadcasts) without leaving the JVM.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabqual.functions.columns import quote, sql_str


def sql_literal(value, dtype: T.DataType) -> str:
    """SQL text for ``value`` typed exactly as ``dtype``."""
    tname = dtype.simpleString()
    if value is None:
        return f"CAST(NULL AS {tname})"
    if isinstance(dtype, T.StringType):
        return sql_str(str(value))
    if isinstance(dtype, T.BooleanType):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"CAST({sql_str(repr(value))} AS {tname})"
    if isinstance(value, (dt.datetime, dt.date)):
        text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
        return f"CAST({sql_str(text)} AS {tname})"
    return f"CAST({sql_str(str(value))} AS {tname})"


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """A DataFrame holding ``rows`` (a handful of values known on the driver)."""
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not rows:
        cols = [f"{sql_literal(None, f.dataType)} AS {quote(f.name)}" for f in st.fields]
        return spark.range(0).selectExpr(*cols)
    structs = []
    for row in rows:
        parts = ", ".join(f"{sql_str(f.name)}, {sql_literal(v, f.dataType)}" for f, v in zip(st.fields, row))
        structs.append(f"named_struct({parts})")
    return spark.range(1).selectExpr(f"inline(array({', '.join(structs)}))")
