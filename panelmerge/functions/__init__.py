"""Column-level helpers (JVM-side expressions only, no Python UDFs)."""

from panelmerge.functions.nulls import (
    NA_TOKENS, nan_to_null, na_tokens_to_null, to_number, strip_ws, clean_text,
)
from panelmerge.functions.scalar import (
    abs_gap, decade, gap, grade_dq, grade_value, fill_flag, missing_flag,
    accuracy_status, truncate_label, row_spread, source_count,
)

__all__ = [
    "NA_TOKENS", "nan_to_null", "na_tokens_to_null", "to_number", "strip_ws",
    "clean_text", "abs_gap", "decade", "gap", "grade_dq", "grade_value",
    "fill_flag", "missing_flag", "accuracy_status", "truncate_label",
    "row_spread", "source_count",
]
