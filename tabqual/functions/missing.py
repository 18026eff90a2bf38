"""Row-level missing-value expressions (JVM-side, codegen friendly).

``missing(c) := c IS NULL OR trim(cast(c AS string)) = ''`` where ``trim``
strips spaces only. Column inventory uses plain SQL NULL instead; both
definitions are kept under distinct names.

Expressions are written as SQL text and parsed once by Spark: the plan is the
same as with chained column functions, but building a wide expression costs
one call into the JVM instead of one per function.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabqual.functions.columns import quote


def missing_sql(name: str) -> str:
    c = quote(name)
    return f"({c} IS NULL OR trim(CAST({c} AS STRING)) = '')"


def missing_flag_sql(name: str) -> str:
    return f"CASE WHEN {missing_sql(name)} THEN 1 ELSE 0 END"


def present_flag_sql(name: str) -> str:
    return f"CASE WHEN {missing_sql(name)} THEN 0 ELSE 1 END"


def balanced_sum_sql(terms: Sequence[str]) -> str:
    """Pairwise sum so that very wide rows give a shallow expression tree."""
    terms = list(terms)
    if not terms:
        return "0"
    while len(terms) > 1:
        nxt = [f"({terms[i]} + {terms[i + 1]})" for i in range(0, len(terms) - 1, 2)]
        if len(terms) % 2:
            nxt.append(terms[-1])
        terms = nxt
    return terms[0]


def is_missing(name: str) -> Column:
    """True when the value is NULL or blank after trimming spaces."""
    return F.expr(missing_sql(name))


def is_present(name: str) -> Column:
    return F.expr(f"NOT {missing_sql(name)}")


def missing_flag(name: str) -> Column:
    """1 when missing, else 0 (int)."""
    return F.expr(missing_flag_sql(name))


def present_flag(name: str) -> Column:
    """1 when present, else 0 (int)."""
    return F.expr(present_flag_sql(name))


def balanced_sum(terms: Sequence[Column]) -> Column:
    """Pairwise sum of column expressions."""
    terms = list(terms)
    if not terms:
        return F.lit(0)
    while len(terms) > 1:
        nxt = [terms[i] + terms[i + 1] for i in range(0, len(terms) - 1, 2)]
        if len(terms) % 2:
            nxt.append(terms[-1])
        terms = nxt
    return terms[0]


def non_empty_count_sql(columns: Sequence[str]) -> str:
    return f"CAST({balanced_sum_sql([present_flag_sql(c) for c in columns])} AS INT)"


def non_empty_count(columns: Sequence[str]) -> Column:
    """Number of present values across ``columns`` (int)."""
    return F.expr(non_empty_count_sql(columns))


def missing_count(columns: Sequence[str]) -> Column:
    return F.expr(f"CAST({balanced_sum_sql([missing_flag_sql(c) for c in columns])} AS INT)")


def completeness_ratio_sql(columns: Sequence[str]) -> str:
    if not columns:
        return "CAST(1.0 AS DOUBLE)"
    return f"({non_empty_count_sql(columns)} / CAST({float(len(columns))!r} AS DOUBLE))"


def completeness_ratio(columns: Sequence[str]) -> Column:
    """Share of present values across ``columns`` (double); 1.0 for no columns."""
    return F.expr(completeness_ratio_sql(columns))


def safe_ratio_sql(numerator: str, denominator: str) -> str:
    return f"coalesce(try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE)), CAST(0.0 AS DOUBLE))"


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``x / total`` with 0.0 when the total is zero or NULL."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))
