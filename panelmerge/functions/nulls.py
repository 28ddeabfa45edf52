"""One null model for the whole library.

Spark has two missing markers (NULL and NaN); NaN counts as present, poisons
``avg``/``max`` and fails range predicates. Every value entering the library is
therefore normalised here: NaN becomes NULL, the usual missing-value tokens of
text files become NULL, and numeric coercion never raises (ANSI mode stays on).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text tokens a CSV reader treats as missing by default
# (compared after trimming, case-sensitive, as written in data files).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Unicode whitespace at either end, matching Python's str.strip(): Java's \s
# under (?U) is the Unicode White_Space set; \x1c-\x1f are added because
# Python also strips those separators. Spark's trim only removes the space.
# The byte-order mark is not white space to either; it is stripped as well.
_EDGE_WS = r"(?U)^[\s\x1c-\x1f\ufeff]+|[\s\x1c-\x1f\ufeff]+$"

# Letters that no decimal number has. Spark's cast alone would also take the type
# suffixes of Java literals ("10d", "1f"), hexadecimal floats and words for infinity.
_NOT_NUMBER = "[A-DF-Za-df-z]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL for a floating column; other values unchanged."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def na_tokens_to_null(c, tokens=NA_TOKENS) -> Column:
    """Text column with missing-value tokens turned into NULL."""
    c = _col(c)
    return F.when(F.trim(c).isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def to_number(c, dtype: str = "double") -> Column:
    """Coerce to a number; anything unparsable (or NaN) becomes NULL."""
    text = _col(c).cast("string")   # the cast trims blanks itself
    num = F.when(~text.rlike(_NOT_NUMBER), text).try_cast(dtype)
    if dtype in ("double", "float"):
        return nan_to_null(num)
    return num


def strip_ws(c) -> Column:
    """Strip Unicode whitespace (tabs, NBSP, ...) and byte-order marks at both ends."""
    return F.regexp_replace(_col(c), _EDGE_WS, "")


def clean_text(c) -> Column:
    """Strip whitespace, then NA tokens -> NULL."""
    return na_tokens_to_null(strip_ws(c))
