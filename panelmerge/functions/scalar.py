"""Scalar column expressions used by the reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gap(a, b) -> Column:
    """Signed gap a - b (NULL if either side is NULL)."""
    return _col(a) - _col(b)


def abs_gap(a, b) -> Column:
    """Absolute divergence |a - b|."""
    return F.abs(_col(a) - _col(b))


def decade(c) -> Column:
    """Decade bucket (p // 10) * 10 as an integer."""
    return (F.floor(_col(c) / 10) * 10).cast("int")


def truncate_label(c, width: int = 28, keep: int = 25) -> Column:
    """Labels longer than ``width`` become the first ``keep`` chars + '...'."""
    s = _col(c).cast("string")
    return F.when(F.length(s) > width, F.concat(F.substring(s, 1, keep), F.lit("..."))).otherwise(s)


def source_count(cols) -> Column:
    """Number of non-null columns in the row."""
    return reduce(lambda x, y: x + y, [_col(c).isNotNull().cast("int") for c in cols])


def row_spread(cols) -> Column:
    """max - min over the row's non-null values (NULL when all are NULL)."""
    cols = [_col(c) for c in cols]
    if len(cols) == 1:
        return F.when(cols[0].isNotNull(), F.lit(0.0))
    return F.greatest(*cols) - F.least(*cols)


# Report thresholds and grade cut-offs.
FILL_GOOD, FILL_WARN = 90.0, 50.0          # completeness flags (> good, > warn)
ACCURACY_PASS, ACCURACY_WARN = 3.5, 5.0    # mean |delta| status
DQ_GRADES = ((100.0, "A"), (80.0, "B"), (60.0, "C"))
VALUE_GRADES = ((90.0, "A"), (75.0, "B"), (60.0, "C"))


def fill_flag(pct) -> Column:
    p = _col(pct)
    return F.when(p > FILL_GOOD, "ok").when(p > FILL_WARN, "warn").otherwise("red")


def missing_flag(pct) -> Column:
    p = _col(pct)
    return F.when(p == 0, "none").when(p < 50, "warn").otherwise("red")


def accuracy_status(mean_abs) -> Column:
    m = _col(mean_abs)
    return F.when(m < ACCURACY_PASS, "pass").when(m < ACCURACY_WARN, "warn").otherwise("fail")


def _grade(score, cuts) -> Column:
    s = _col(score)
    expr = None
    for cut, g in cuts:
        expr = F.when(s >= cut, g) if expr is None else expr.when(s >= cut, g)
    return expr.otherwise("D")


def grade_dq(score) -> Column:
    """A = 100, B >= 80, C >= 60, else D."""
    return _grade(score, DQ_GRADES)


def grade_value(score) -> Column:
    """A >= 90, B >= 75, C >= 60, else D."""
    return _grade(score, VALUE_GRADES)
