"""Cleaning expressions.

All are built-in Column expressions: they stay inside whole-stage codegen and
need no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that pandas' CSV reader turns into a missing value when
# a column is read as strings.
NA_TOKENS = ["", "NA", "N/A", "n/a", "NULL", "null", "NaN", "nan", "None", "<NA>", "#N/A", "-NaN", "-nan",
             "#NA", "#N/A N/A", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN"]

# A decimal number as Python's float() accepts it for the inputs we meet:
# optional sign, digits with an optional fraction, optional exponent.
NUMERIC_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col: str | Column) -> Column:
    """Python ``str.strip()``: remove every leading/trailing whitespace char,
    the Unicode ones and the separators 0x1C-0x1F too (P5)."""
    return F.regexp_replace(_c(col), r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")


def na_to_null(col: str | Column) -> Column:
    """Null for the tokens a string CSV read treats as missing."""
    c = _c(col)
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def normalize_key(col: str | Column) -> Column:
    """Trimmed upper-case key; blank becomes null so it cannot take weight."""
    k = F.upper(strip_ws(_c(col)))
    return F.when(k == "", F.lit(None).cast("string")).otherwise(k)


def to_number(col: str | Column) -> Column:
    """``to_numeric(errors='coerce')``: double or null.

    Guarded by a numeric pattern so that text Spark alone would accept
    (``1d``, ``1_000`` style suffixes) is null, as in pandas."""
    s = strip_ws(_c(col).cast("string"))
    return F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double"))


def to_int(col: str | Column) -> Column:
    """Integer parse going through double, truncating toward zero; null
    when unparsable or out of the bigint range."""
    return to_number(col).try_cast("bigint")


def clean_measure(col: str | Column) -> Column:
    """Suppressed-count parse (P10): null, blank, ``*`` or unparsable -> 0,
    else the number truncated toward zero."""
    d = to_number(col)
    # inf, nan and values beyond the bigint range are not counts: 0, like
    # the other unusable cells (an ANSI cast would raise on them)
    in_range = d.isNotNull() & (F.abs(d) < F.lit(9.2e18))
    return F.when(in_range, d.cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def normalize_code(col: str | Column, width: int = 5) -> Column:
    """Digits only, keep the last ``width``, left-pad with zeros.
    Null or digit-free input becomes all zeros."""
    digits = F.regexp_replace(F.coalesce(_c(col).cast("string"), F.lit("")), r"[^0-9]", "")
    tail = F.when(F.length(digits) > width, F.substring(digits, -width, width)).otherwise(digits)
    return F.lpad(tail, width, "0")


def pad_code(col: str | Column, width: int = 5) -> Column:
    """``LPAD(CAST(c AS VARCHAR), width, '0')``."""
    return F.lpad(_c(col).cast("string"), width, "0")


def compose_code(state: str | Column, county: str | Column) -> Column:
    """Two-part code, 2 + 3 characters."""
    return F.concat(F.lpad(_c(state).cast("string"), 2, "0"),
                    F.lpad(_c(county).cast("string"), 3, "0"))


def equals_or_blank(col: str | Column, value: str) -> Column:
    """``col.fillna('') == value``."""
    return F.coalesce(_c(col), F.lit("")) == F.lit(value)


def contains_ci(col: str | Column, needle: str) -> Column:
    """Case-insensitive contains; null is false."""
    return F.coalesce(F.lower(_c(col)).contains(needle.lower()), F.lit(False))


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Null when the denominator is not positive."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, n / d)


def inf_to_null(col: str | Column) -> Column:
    """Replace +/-inf and NaN with null."""
    c = _c(col)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def clip_lower(col: str | Column, low: float, fill: float | None = None) -> Column:
    """``fillna(fill).clip(lower=low)``."""
    c = _c(col)
    if fill is not None:
        c = F.coalesce(c, F.lit(fill))
    return F.when(c.isNull(), c).otherwise(F.greatest(c, F.lit(low)))
