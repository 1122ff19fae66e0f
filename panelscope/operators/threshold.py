"""Near-threshold sample and band comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import BAND_HIGH, BAND_LOW, threshold_band, threshold_flag


def rating_base(ratings: DataFrame, exposure: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ratings left-joined to an exposure table on the entity-period key."""
    return ratings.join(exposure, list(keys), "left")


def near_threshold(base: DataFrame, rating: str, value: str, low: float = 3.5, high: float = 4.5,
                   threshold: float = 4.0, scope_col: str | None = "out_of_scope") -> DataFrame:
    """Rows with a rating in [low, high], a non-null value and in scope,
    flagged above the threshold and banded (P20, P21)."""
    keep = F.col(rating).isNotNull() & F.col(value).isNotNull() & (F.col(rating) >= low) & (F.col(rating) <= high)
    if scope_col:
        keep = keep & (F.col(scope_col) == 0)
    return (base.filter(keep)
            .withColumn("above_threshold", threshold_flag(rating, threshold))
            .withColumn("threshold_band", threshold_band(rating, low, threshold, high)))


def band_counts(near: DataFrame, by: str, band: str = "threshold_band", size: str = "total_measure") -> DataFrame:
    """Rows and summed size per period and band."""
    return near.groupBy(by, band).agg(
        F.count(F.lit(1)).alias("entities"),
        F.sum(size).alias("total_size"),
    )


def weighted_mean(x: str, w: str):
    """``sum(x*w) / nullif(sum(w), 0)`` as an aggregate expression."""
    return F.try_divide(F.sum(F.col(x) * F.col(w)), F.nullif(F.sum(w).cast("double"), F.lit(0.0)))


def band_means(near: DataFrame, by: str, value: str, size: str = "total_measure",
               band: str = "threshold_band") -> DataFrame:
    """Mean and size-weighted mean per period and band, one pass."""
    return near.groupBy(by, band).agg(
        F.avg(value).alias("mean_value"),
        weighted_mean(value, size).alias("weighted_mean_value"),
    )


def band_difference(near: DataFrame, by: str, value: str, size: str = "total_measure",
                    band: str = "threshold_band", low: str = BAND_LOW, high: str = BAND_HIGH) -> DataFrame:
    """Weighted mean of the low band minus the high band, per period.

    The reference self-joins the per-band aggregate; conditional sums in a
    single grouped aggregate give the same rows without a second pass.  A
    period missing either band is dropped, as the inner join does."""
    x, t, b = F.col(value), F.col(size), F.col(band)
    g = near.groupBy(by).agg(
        F.sum(F.when(b == low, x * t)).alias("_nl"), F.sum(F.when(b == low, t)).alias("_dl"),
        F.sum(F.when(b == high, x * t)).alias("_nh"), F.sum(F.when(b == high, t)).alias("_dh"),
        F.count_if(b == low).alias("_cl"), F.count_if(b == high).alias("_ch"),
    )
    ew_low = F.try_divide(F.col("_nl"), F.nullif(F.col("_dl").cast("double"), F.lit(0.0)))
    ew_high = F.try_divide(F.col("_nh"), F.nullif(F.col("_dh").cast("double"), F.lit(0.0)))
    return (g.filter((F.col("_cl") > 0) & (F.col("_ch") > 0))
            .select(by, ew_low.alias("ew_mean_low"), ew_high.alias("ew_mean_high"),
                    (ew_low - ew_high).alias("diff_low_minus_high")))
