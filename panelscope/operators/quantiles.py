"""Exact quantiles with linear interpolation, per group.

One way for every size:

1. rows are counted by (group, value), so ties and repeated values combine in
   the tasks that read them and a value that fills a group is one row;
2. one range shuffle of the counted values on (group, value), written once to
   the checkpoint folder with the partition id (so every later read agrees);
3. rows per (partition, group) give cumulative offsets (a small table);
4. for each wanted probability p: position h = (n - 1) p, ranks floor(h) and
   ceil(h), and the (partition, group) slices that hold them;
5. those slices alone are summed up, the two values picked and interpolated:
   (ceil(h) - h) * x_lo + (h - floor(h)) * x_hi.

No task holds more than one range partition; nothing reaches the driver.
Groups are compared as structs, so a null group is a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    partitions: int | None = None) -> DataFrame:
    """Exact linear quantiles of the non-null values: (by..., p_index, p, q)."""
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    key = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0))
    counted = (df.select(key.alias("_g"), F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
               .groupBy("_g", "_x").agg(F.count(F.lit(1)).alias("_c")))
    ranged = materialize(counted.repartitionByRange(parts, "_g", "_x").withColumn("_pid", F.spark_partition_id()),
                         "quantile_sort")
    sums = ranged.groupBy("_g", "_pid").agg(F.sum("_c").alias("_n"))
    # at most `parts` rows for each group
    offsets = sums.select("_g", "_pid", "_n", (F.sum("_n").over(Window.partitionBy("_g").orderBy("_pid")) - F.col("_n")).alias("_off"))
    targets = (offsets.groupBy("_g").agg(F.sum("_n").alias("_total"))
               .select("_g", F.posexplode(wanted).alias("p_index", "p"), "_total")
               .withColumn("_h", (F.col("_total") - 1).cast("double") * F.col("p")))
    ranks = targets.select("_g", F.explode(F.array_distinct(F.array(F.floor("_h"), F.ceil("_h")))).alias("_rank")).distinct()
    slices = offsets.join(ranks, "_g").filter((F.col("_rank") >= F.col("_off")) & (F.col("_rank") < F.col("_off") + F.col("_n")))
    need = slices.groupBy("_g", "_pid", "_off").agg(F.collect_list("_rank").alias("_ranks"))
    run = F.sum("_c").over(Window.partitionBy("_g", "_pid").orderBy("_x"))
    held = ranged.join(need, ["_g", "_pid"]).withColumn("_end", F.col("_off") + run)
    picked = held.select("_g", "_x", F.explode(F.filter(
        "_ranks", lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_c")))).alias("_rank"))
    at = picked.groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at"))
    lo, hi = F.floor("_h"), F.ceil("_h")
    x = lambda r: F.element_at("_at", r)
    q = F.when(lo == hi, x(lo)).otherwise((hi.cast("double") - F.col("_h")) * x(lo) + (F.col("_h") - lo.cast("double")) * x(hi))
    return targets.join(at, "_g").select(*[F.col("_g")[c].alias(c) for c in by], "p_index", "p", q.alias("q"))


# ------------------------------------------------------------------ approximate, on request

#: The k of a sketch (numbers held at its widest level), and twice the rank error
#: that one quantile stays within with 99% probability, 2.3 / k ** 0.9.
SKETCH_K, RANK_ERROR = 800, 0.0112


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., sketch): one KLL sketch of the non-null values of each group, a
    few kilobytes whatever their number.  Sketches can be stored and merged, so
    a new period is added without reading the old ones again.  Never a default:
    the exact quantiles above are."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), SKETCH_K).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., sketch): the sketches of each coarser group as one."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch"))


def approximate_quantiles(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., p, q, rank_error): ``q`` is a value whose rank among the group's
    values is within ``rank_error`` of ``p``."""
    edges = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("q"))
                      for p in probs])
    return sketches.select(*by, F.inline(edges)).withColumn("rank_error", F.lit(RANK_ERROR))
