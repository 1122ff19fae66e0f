"""Report frames over a decomposition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import OTHER_BAND, near_flag, report_band, residual_bucket
from .quantiles import exact_quantiles

def near_slices(df: DataFrame, rating: str = "rating",
                slices: Sequence[tuple[str, float, float]] = (("3.0-3.9", 3.0, 3.9), ("3.5-3.9", 3.5, 3.9))) -> DataFrame:
    """Rows rated inside each inclusive range, tagged with the slice name."""
    out = None
    for name, lo, hi in slices:
        part = df.filter(F.col(rating).between(lo, hi)).withColumn("slice", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def bucket_summary(df: DataFrame, by: str, residual: str = "residual",
                   means: dict[str, str] | None = None) -> DataFrame:
    """Residual bucket per row, then per period and bucket n and means."""
    means = means or {}
    return (df.withColumn("bucket", residual_bucket(residual))
            .groupBy(by, "bucket")
            .agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(o) for o, c in means.items()]))


def ranked(df: DataFrame, order: Sequence[str], n: int, rating: str = "rating",
           lo: float = 3.5, hi: float = 3.9, cols: Sequence[str] | None = None,
           per_group: str | None = None) -> DataFrame:
    """Rows rated in [lo, hi], sorted by ``order`` (all ascending, the last
    key unique), first ``n`` overall (O3) or per ``per_group`` (H14)."""
    s = df.filter(F.col(rating).between(lo, hi))
    if per_group:
        return top_n_per_group(s, per_group, order, n).select(*(cols or s.columns))
    # sort + limit plans as TakeOrderedAndProject: each task keeps its own
    # top n, only n rows per task reach the final merge
    return s.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n).select(*(cols or s.columns))


def top_n_per_group(df: DataFrame, group: str, order: Sequence[str], n: int, salt_buckets: int = 16) -> DataFrame:
    """First ``n`` rows of each group by ``order`` (ascending, last key
    unique), skew-safe: rank inside ``salt_buckets`` hash sub-groups first,
    keep n of each (the group's first n are always among them), then rank
    the at most ``n * salt_buckets`` candidates per group."""
    from pyspark.sql import Window
    keys = [F.col(c).asc_nulls_last() for c in order]
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(salt_buckets))
    w1 = Window.partitionBy(group, "_salt").orderBy(*keys)
    cand = (df.withColumn("_salt", salt).withColumn("_rn", F.row_number().over(w1))
            .filter(F.col("_rn") <= n).drop("_salt"))
    w2 = Window.partitionBy(group).orderBy(*keys)
    return cand.withColumn("_rn", F.row_number().over(w2)).filter(F.col("_rn") <= n).drop("_rn")


def display_slice(top: DataFrame, order: Sequence[str], n: int = 15,
                  formats: dict[str, str] | None = None) -> DataFrame:
    """First ``n`` rows of a ranked list with display formatting."""
    s = top.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
    cols = []
    for c in s.columns:
        fmt = (formats or {}).get(c)
        cols.append(F.format_string(fmt, F.col(c)).alias(c) if fmt else F.col(c))
    return s.select(*cols)


def summary_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``describe()``: count, mean, std (n-1), min, 25/50/75% (exact, linear)
    and max per column, one row per statistic (A19).

    The columns are unpivoted to (column, value) once, so every statistic is
    one grouped aggregate keyed by column name and the quartiles are one
    ``exact_quantiles`` call; the small result is pivoted back to one column
    per input column."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v"))
                                         for c in cols])))
    v = F.col("_v")
    moments = long.groupBy("_col").agg(
        F.count(v).cast("double").alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    stats_long = moments.select("_col", F.inline(F.array(*[
        F.struct(F.lit(s).alias("stat"), F.col(s).alias("_v")) for s in ("count", "mean", "std", "min", "max")])))
    qs = exact_quantiles(long, "_v", [0.25, 0.5, 0.75], by=["_col"])
    names = F.array(F.lit("25%"), F.lit("50%"), F.lit("75%"))
    q_long = qs.select("_col", names[F.col("p_index")].alias("stat"), F.col("q").alias("_v"))
    out = stats_long.unionByName(q_long).groupBy("stat").pivot("_col", list(cols)).agg(F.first("_v"))
    return out.select("stat", *cols)


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Five-number summary per group: quartiles (exact, linear) and whiskers
    at the most extreme values within 1.5 IQR of the box (A23)."""
    qs = exact_quantiles(df, value, [0.25, 0.5, 0.75], by=[by])
    q = (qs.groupBy(by).agg(*[F.max(F.when(F.col("p_index") == i, F.col("q"))).alias(n)
                              for i, n in enumerate(("q1", "median", "q3"))])
         .join(df.groupBy(by).agg(F.count(value).alias("n")), by))
    iqr = F.col("q3") - F.col("q1")
    fences = q.select(by, "n", "q1", "median", "q3", (F.col("q1") - 1.5 * iqr).alias("_lo"),
                      (F.col("q3") + 1.5 * iqr).alias("_hi"))
    v = F.col(value)
    # the fences table has one row per group: it is joined to the rows
    w = (df.join(fences.select(by, "_lo", "_hi"), by)
         .groupBy(by).agg(F.min(F.when(v >= F.col("_lo"), v)).alias("whisker_low"),
                          F.max(F.when(v <= F.col("_hi"), v)).alias("whisker_high"),
                          F.count_if((v < F.col("_lo")) | (v > F.col("_hi"))).alias("outliers")))
    return fences.drop("_lo", "_hi").join(w, by)


def residual_box(df: DataFrame, rating: str = "rating", residual: str = "residual") -> DataFrame:
    """Residual box per report band (M20, P24); rows below the lowest named
    band are left out."""
    banded = df.withColumn("report_band", report_band(rating)).filter(F.col("report_band") != OTHER_BAND)
    return box_stats(banded, residual, "report_band")


def scatter_frame(df: DataFrame, expected: str = "expected_rating", observed: str = "rating") -> DataFrame:
    """Expected vs observed with the near flag, plus the reference-line end
    points (min and max over both axes) as columns (M19, P25).  The extremes
    are a scalar subquery, computed once."""
    ends = df.agg(F.struct(F.least(F.min(expected), F.min(observed)).alias("lo"),
                           F.greatest(F.max(expected), F.max(observed)).alias("hi"))).scalar()
    return df.select("entity_id", "period", expected, observed, near_flag(observed).alias("near_flag"),
                     ends["lo"].alias("line_min"), ends["hi"].alias("line_max"))
