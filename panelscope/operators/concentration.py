"""Concentration indices and size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_sum(df: DataFrame, keys: Sequence[str], value: str, tiebreak: str, k: int = 5,
              salt_buckets: int = 16, out: str = "top_k") -> DataFrame:
    """Sum of the ``k`` largest values per key (W2 + W3), skew-safe.

    A window partitioned by the key alone puts a hot key into one task (AQE
    does not split windows).  Rows are first spread over ``salt_buckets``
    sub-groups by a hash of the tiebreak column; the top ``k`` of each
    sub-group are kept (the overall top ``k`` is always among them), and the
    final ranking runs over at most ``k * salt_buckets`` rows per key.  Ties
    are broken by ``tiebreak``; they cannot change the sum."""
    salt = F.pmod(F.xxhash64(F.col(tiebreak)), F.lit(salt_buckets))
    order = [F.col(value).desc(), F.col(tiebreak).asc()]
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    cand = (df.select(*keys, value, tiebreak).withColumn("_salt", salt)
            .withColumn("_rn", F.row_number().over(w1)).filter(F.col("_rn") <= k))
    w2 = Window.partitionBy(*keys).orderBy(*order)
    top = cand.withColumn("_rn", F.row_number().over(w2)).filter(F.col("_rn") <= k)
    return top.groupBy(*keys).agg(F.sum(value).alias(out))


def top_k_floor(value: Column, tiebreak: str, k: int = 5, salt_buckets: int = 8) -> Column:
    """Aggregate: a value no larger than the ``k``-th largest of the group, so
    that the rows from it upwards hold the top ``k``.

    The maxima of ``salt_buckets`` hash buckets are rows of the group, hence the
    ``k``-th largest of them is such a value, and a close one: few rows reach it
    unless they are tied.  Null where fewer than ``k`` buckets have a row, and
    all rows count.  Plain maxima add up map-side and need no sort."""
    salt = F.pmod(F.xxhash64(F.col(tiebreak)), F.lit(salt_buckets))
    maxima = F.array(*[F.max(F.when(salt == b, value)) for b in range(salt_buckets)])
    return F.get(F.sort_array(maxima, asc=False), F.lit(k - 1))


def concentration_aggs(weight: str = "weight") -> list:
    """HHI, entropy, top-1 share and unit count over positive weights, as
    aggregate expressions (shareable with other per-key aggregates)."""
    w = F.col(weight).cast("double")
    pos = w > 0
    return [F.sum(F.when(pos, w * w)).alias("hhi"),
            (-F.sum(F.when(pos, w * F.log(w))) + F.lit(0.0)).alias("entropy"),
            F.max(F.when(pos, w)).alias("top1_share"),
            F.count(F.when(pos, w)).alias("n_units")]


def concentration(weights: DataFrame, keys: Sequence[str], weight: str = "weight",
                  unit: str = "unit_code", k: int = 5, salt_buckets: int = 16) -> DataFrame:
    """Per key: HHI = sum w^2, entropy = -sum w ln w, top-1 share, top-k
    share, unit count (A22).  Only positive weights enter, so ``ln`` is
    finite."""
    w = F.col(weight).cast("double")
    pos = weights.filter(F.col(weight).isNotNull() & (F.col(weight) > 0)).select(*keys, unit, w.alias("_w"))
    base = pos.groupBy(*keys).agg(
        F.sum(F.col("_w") * F.col("_w")).alias("hhi"),
        (-F.sum(F.col("_w") * F.log(F.col("_w"))) + F.lit(0.0)).alias("entropy"),
        F.max("_w").alias("top1_share"),
        F.count(F.lit(1)).alias("n_units"),
    )
    top = top_k_sum(pos, keys, "_w", unit, k=k, salt_buckets=salt_buckets, out=f"top{k}_share")
    return base.join(top, list(keys)).select(*keys, "hhi", "entropy", "top1_share", f"top{k}_share", "n_units")


def entity_size(weights: DataFrame, keys: Sequence[str], total: str = "total_measure") -> DataFrame:
    """Per key size as a double, the max of a per-key constant."""
    return (weights.filter(F.col(total).isNotNull())
            .groupBy(*keys).agg(F.max(F.col(total).cast("double")).alias("total_size")))
