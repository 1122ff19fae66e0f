"""Panel, share weights and their QC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aggregate_panel(rows: DataFrame, keys: Sequence[str], measure: str, out: str = "measure",
                    extra: dict | None = None) -> DataFrame:
    """Sum plan-level rows to one row per key (A1).

    A grouped sum, so Spark combines map-side before the shuffle: a hot key
    costs one partial row per task, not its row count.  Rows with a null key
    are dropped, as pandas ``groupby`` does.  ``extra`` adds named
    aggregates computed in the same pass."""
    keep = rows
    for k in keys:
        keep = keep.filter(F.col(k).isNotNull())
    aggs = [F.sum(measure).alias(out)] + [c.alias(n) for n, c in (extra or {}).items()]
    return keep.groupBy(*keys).agg(*aggs)


def positive(measure: str = "measure") -> Column:
    """The measure where it has a weight, else null."""
    return F.when(F.col(measure) > 0, F.col(measure))


def group_totals(panel: DataFrame, group: Sequence[str], measure: str = "measure",
                 total: str = "total_measure", extra: dict | None = None) -> DataFrame:
    """Total of the positive measures of every group (null without one);
    ``extra`` adds named aggregates of the same pass, over all rows."""
    return panel.groupBy(*group).agg(F.sum(positive(measure)).alias(total), *[c.alias(n) for n, c in (extra or {}).items()])


def share_weights(panel: DataFrame, group: Sequence[str], measure: str = "measure",
                  total: str = "total_measure", weight: str = "weight", totals: DataFrame | None = None) -> DataFrame:
    """Share of the group total, after dropping null and non-positive
    measures (W1).

    Written as aggregate + equi-join rather than a window: the totals are a
    pre-aggregated, entity-period sized table, AQE may broadcast it when it
    is measured small at run time, and a sort-merge join can be split by AQE's
    skew handling when one group holds a large share of rows.  A window
    partitioned by the group would put a hot group into one task.

    ``totals``, of :func:`group_totals` and written before, has a size that is
    known when the join is planned; its further columns are carried along."""
    pos = panel.filter(F.col(measure).isNotNull() & (F.col(measure) > 0))
    if totals is None:
        totals = pos.groupBy(*group).agg(F.sum(measure).alias(total))
    return (
        pos.join(totals, list(group))
        .withColumn(weight, F.col(measure).cast("double") / F.col(total).cast("double"))
    )


def weight_sum_qc(weights: DataFrame, group: Sequence[str], by: str, weight: str = "weight") -> DataFrame:
    """Two-level check that weights sum to one (A9): sum per group, then
    count / avg / min / max of those sums per ``by``."""
    sums = weights.groupBy(*group).agg(F.sum(weight).alias("wsum"))
    return sums.groupBy(by).agg(
        F.count(F.lit(1)).alias("groups_checked"),
        F.avg("wsum").alias("avg_weight_sum"),
        F.min("wsum").alias("min_weight_sum"),
        F.max("wsum").alias("max_weight_sum"),
    )
