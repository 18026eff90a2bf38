"""Column expressions shared by the operators."""

from tabqual.functions.columns import (
    LEAKAGE_COLUMNS,
    first_name_column,
    numeric_columns,
    qcol,
    quote,
    string_columns,
)
from tabqual.functions.missing import (
    balanced_sum,
    completeness_ratio,
    is_missing,
    is_present,
    missing_flag,
    non_empty_count,
    present_flag,
    safe_ratio,
)

__all__ = [
    "LEAKAGE_COLUMNS", "balanced_sum", "completeness_ratio", "first_name_column",
    "is_missing", "is_present", "missing_flag", "non_empty_count", "numeric_columns",
    "present_flag", "qcol", "quote", "safe_ratio", "string_columns",
]
