"""Rating bands, flags and buckets.

The reference uses three band definitions that disagree on (3.9, 4.0); each
is kept under its own name, with the cut points as parameters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels used by the reference's tables.
BAND_LOW = "3.5-3.9"
BAND_HIGH = "4.0-4.5"
BAND_OTHER = "other"

BUCKET_OVER = "Operational overperformance (above structural expectation)"
BUCKET_UNDER = "Operational underperformance (execution opportunity)"
BUCKET_NEAR = "Near expectation (within ±0.25)"

REPORT_BANDS = ["3.0-3.4", "3.5-3.9", "4.0+", "<3.0"]


#: Fixed value: the band of ratings below every named one.
OTHER_BAND = "<3.0"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def threshold_flag(col: str | Column, threshold: float = 4.0) -> Column:
    """1 when rating >= threshold else 0 (P20); null rating gives 0."""
    return F.when(_c(col) >= threshold, 1).otherwise(0).cast("int")


def threshold_band(col: str | Column, low: float = 3.5, mid: float = 4.0, high: float = 4.5) -> Column:
    """[low, mid) / [mid, high] / other."""
    c = _c(col)
    return (F.when((c >= low) & (c < mid), F.lit(BAND_LOW))
            .when((c >= mid) & (c <= high), F.lit(BAND_HIGH))
            .otherwise(F.lit(BAND_OTHER)))


def ordinal_flag(col: str | Column, cut: int = 4) -> Column:
    """Null-preserving flag: null -> null, code >= cut -> 1, else 0."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None).cast("int")).when(c >= cut, 1).otherwise(0).cast("int")


def residual_bucket(col: str | Column, margin: float = 0.25) -> Column:
    """over / under / near; a null residual falls to near."""
    c = _c(col)
    return (F.when(c >= margin, F.lit(BUCKET_OVER))
            .when(c <= -margin, F.lit(BUCKET_UNDER))
            .otherwise(F.lit(BUCKET_NEAR)))


def report_band(col: str | Column) -> Column:
    """[3.0,3.5) / [3.5,3.9] / >=4.0 / everything else incl. (3.9,4.0) and null."""
    c = _c(col)
    return (F.when((c >= 3.0) & (c < 3.5), F.lit("3.0-3.4"))
            .when((c >= 3.5) & (c <= 3.9), F.lit("3.5-3.9"))
            .when(c >= 4.0, F.lit("4.0+"))
            .otherwise(F.lit(OTHER_BAND)))


def near_flag(col: str | Column, low: float = 3.0, high: float = 3.9) -> Column:
    """``low <= rating <= high`` as 0/1 (P25)."""
    c = _c(col)
    return F.when(c.between(low, high), 1).otherwise(0).cast("int")


def period_label(col: str | Column, labels: dict[int, str]) -> Column:
    """Map a period code to a label; unknown codes give 'Unknown' (P26)."""
    c = _c(col)
    expr = None
    for k, v in labels.items():
        expr = (F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v)))
    return F.lit("Unknown") if expr is None else expr.otherwise(F.lit("Unknown"))
