"""Equal-count binning with tie collapse, and the decile effect table
(W4, M15, M21)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles


def quantile_edges(df: DataFrame, col: str, q: int = 10) -> Column:
    """Exact pooled quantile edges 0, 1/q, .., 1 (linear interpolation, as
    ``pd.qcut`` computes them), with tied edges collapsed.

    The edges come from ``exact_quantiles`` and are returned as a
    scalar-subquery Column: Catalyst runs it once and hands the small array
    to every task, so no cross join and no driver round trip."""
    probs = [i / q for i in range(q + 1)]
    qs = exact_quantiles(df, col, probs)
    ordered = F.array_sort(F.collect_list(F.struct("p_index", "q")))
    edges = qs.agg(F.array_distinct(F.transform(ordered, lambda s: s["q"])).alias("e"))
    return edges.scalar()


def assign_bin(value: Column, edges: Column) -> Column:
    """1-based bin on right-closed intervals; the minimum is in bin 1:
    ``greatest(1, #edges below value)``."""
    return F.greatest(F.lit(1), F.size(F.filter(edges, lambda e: e < value))).cast("int")


def quantile_bins(df: DataFrame, col: str, q: int = 10, out: str = "decile") -> DataFrame:
    """``pd.qcut(x, q, labels=False, duplicates='drop') + 1`` over all rows
    pooled; rows with a null value are dropped (W4)."""
    edges = quantile_edges(df, col, q)
    # the scalar subquery is projected first: it may not sit inside a lambda
    return (df.filter(F.col(col).isNotNull()).withColumn("_edges", edges)
            .withColumn(out, assign_bin(F.col(col), F.col("_edges"))).drop("_edges"))


def decile_table(df: DataFrame, col: str, label: str, by: str, outcome: str = "rating",
                 expected: str = "expected_rating", residual: str = "residual", q: int = 10) -> DataFrame:
    """Per period and bin: n and the means of the feature, observed,
    expected and residual, label first (M15)."""
    binned = quantile_bins(df.select(col, outcome, expected, residual, by), col, q)
    return binned.groupBy(by, "decile").agg(
        F.count(outcome).alias("n"),
        F.avg(col).alias("feature_mean"),
        F.avg(outcome).alias("rating_mean"),
        F.avg(expected).alias("expected_mean"),
        F.avg(residual).alias("residual_mean"),
    ).select(F.lit(label).alias("feature"), by, "decile", "n", "feature_mean", "rating_mean",
             "expected_mean", "residual_mean")


def gradient_series(table: DataFrame, by: str, keys: Sequence[str] = ("decile",)) -> DataFrame:
    """Expected mean by bin per period, sorted."""
    return table.select(by, *keys, "expected_mean").orderBy(by, *keys)
