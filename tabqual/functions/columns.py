"""Column selection by name and by type, done on the schema (driver metadata only)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Derived columns that must never become features or label
# basis columns (they are computed from the label or the run).
LEAKAGE_COLUMNS = (
    "ingested_at",
    "ingest_year",
    "ingest_month",
    "quality_band",
    "min_ratio",
    "completeness_ratio",
    "non_empty_fields",
    "label",
    "event_order",
)

_NAME = re.compile("name", re.IGNORECASE)


def quote(name: str) -> str:
    """Backtick-quote a column name so spaces and dots are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    return F.col(quote(name))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in skip]


def first_name_column(columns: Sequence[str]) -> str | None:
    """The leftmost column with ``name`` in its own name, in any letter case."""
    named = list(filter(_NAME.search, columns))
    return named[0] if named else None


def ends_with_id(name: str) -> bool:
    return name.lower().endswith("id")


def ordered_unique(names: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(names))


def type_name(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def sql_str(value: str) -> str:
    """A SQL string literal for ``value``."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
