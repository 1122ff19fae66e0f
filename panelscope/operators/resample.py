"""Stratified cluster bootstrap of a two-group mean difference.

Within each stratum (period) and group (band), the distinct ids are
resampled with replacement, n draws for n ids, keeping multiplicity.  How
often an id is drawn follows a multinomial law, which is split exactly: the
draws of a range of ids fall to its lower half by a binomial number, down to
single ids.  The number comes from (seed, stratum, group, range, replicate), so
the result is fixed by the seed, independent of partitioning and task retries,
and reproducible in SQL.

Scale notes:
* no draw is a row: a task finds the counts of its own ids for all replicates
  from the ranges above them, and adds up counts times per-id sums; it sends one
  array a stratum and group, so what is shuffled does not depend on the number
  of replicates but for the length of these arrays;
* the dense id index uses salted buckets: a window per (stratum, group,
  bucket) plus a tiny per-bucket offset table, so no stratum is ever one task;
* rows are reduced to per-id partial sums first, so an id brings four numbers,
  not its rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..session import materialize


def md5_int(*parts: Column | str) -> Column:
    """Non-negative 60-bit integer from the md5 of ``parts`` joined by ':'."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    text = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def dense_index(df: DataFrame, strata: Sequence[str], id_col: str, buckets: int = 64) -> DataFrame:
    """0 .. n-1 index of the distinct non-null ids in each stratum, ordered
    by (md5 bucket, id), plus the stratum size n."""
    ids = df.select(*strata, id_col).filter(F.col(id_col).isNotNull()).distinct()
    ids = ids.withColumn("_bk", F.pmod(md5_int("b", F.col(id_col)), F.lit(buckets)))
    counts = ids.groupBy(*strata, "_bk").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*strata).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*strata)
    counts = counts.select(*strata, "_bk", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                           F.sum("_c").over(whole).alias("n"))
    rn = F.row_number().over(Window.partitionBy(*strata, "_bk").orderBy(id_col))
    return (ids.withColumn("_rn", rn).join(counts, [*strata, "_bk"])
            .select(*strata, id_col, (F.col("_off") + F.col("_rn") - 1).alias("idx"), "n"))


def split_key(seed: int, stratum, group, low: int, high: int) -> int:
    """60 bits that name the split of the ids [low, high)."""
    return int(hashlib.md5(f"{seed}:{stratum}:{group}:{low}:{high}".encode()).hexdigest()[:15], 16)


def uniforms(key: int, n_boot: int) -> np.ndarray:
    """A uniform number in [0, 1) for every replicate of a split: two rounds of
    multiply and shift on key + replicate x an odd constant, mod 2^64."""
    x = np.uint64(key) + np.arange(n_boot, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(11)) / float(1 << 53)


def binomial(n: np.ndarray, part: int, whole: int, u: np.ndarray) -> np.ndarray:
    """The least k whose binomial (n, part / whole) distribution function is
    not below ``u``, for every n and u.

    Equal n share one table of the distribution function, over the values
    within 40 deviations and 64 of the mean: outside, it is 0 or 1 to the last
    bit."""
    out = np.zeros(len(n), dtype=np.int64)
    p = part / whole
    for m in np.unique(n):
        at = np.flatnonzero(n == m)
        m = int(m)
        reach = 40 * math.sqrt(m * p * (1 - p)) + 64
        low, high = max(0, math.floor(m * p - reach)), min(m, math.ceil(m * p + reach))
        k = np.arange(low, high)
        log = math.lgamma(m - low + 1) + math.lgamma(low + 1)  # of k! (m - k)!, by steps from the lowest k
        steps = np.concatenate([[0.0], np.cumsum(np.log((k + 1.0) / (m - k)))])[:len(k)] if len(k) else np.zeros(0)
        mass = np.exp(math.lgamma(m + 1) - log - steps + k * math.log(p) + (m - k) * math.log1p(-p))
        out[at] = low + np.searchsorted(np.cumsum(mass), u[at], side="left")
    return out


def draw_counts(seed: int, stratum, group, n: int, first: int, last: int, n_boot: int) -> np.ndarray:
    """How often each of the ids [first, last) of n is drawn in n draws with
    replacement, for every replicate: (n_boot, last - first).

    The draws of a range of ids go to its halves by one binomial number, from
    all ids down to one.  A number is named by its range, so tasks that hold
    different ids agree without exchanging a draw."""
    out = np.zeros((n_boot, last - first), dtype=np.int64)
    todo = [(0, n, np.full(n_boot, n, dtype=np.int64))]
    while todo:
        low, high, count = todo.pop()
        if high - low == 1:
            out[:, low - first] = count
            continue
        mid = (low + high) // 2
        left = binomial(count, mid - low, high - low, uniforms(split_key(seed, stratum, group, low, high), n_boot))
        todo += [(a, b, c) for a, b, c in ((low, mid, left), (mid, high, count - left)) if a < last and b > first]
    return out


#: Ids whose sums one step of a task multiplies with their counts.
CHUNK = 512


def bootstrap_diff(df: DataFrame, stratum: str, group: str, id_col: str, value: str, weight: str,
                   groups: tuple[str, str], n_boot: int = 2000, seed: int = 42, min_ids: int = 5,
                   buckets: int = 64) -> DataFrame:
    """Per stratum and replicate: unweighted and weighted mean of ``value``
    in ``groups[0]`` minus ``groups[1]``.  A stratum where either group has
    fewer than ``min_ids`` distinct ids is skipped.  Weighted means are null
    when the drawn weight sums to zero; unweighted means skip null values."""
    a, b = groups
    # the sample is read three times (id index, per-id sums, size check):
    # write it once to the shared checkpoint folder
    data = materialize(df.filter(F.col(group).isin(a, b)).select(stratum, group, id_col, value, weight),
                       "bootstrap_sample")
    idx = dense_index(data, [stratum, group], id_col, buckets)
    ok = (idx.select(stratum, group, "n").distinct().groupBy(stratum)
          .agg(F.count_if(F.col("n") >= min_ids).alias("_k")).filter(F.col("_k") == 2).select(stratum))
    idx = idx.join(ok, stratum, "left_semi")
    x, w = F.col(value), F.col(weight)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    per_id = data.groupBy(stratum, group, id_col).agg(
        zero(F.sum(x)).alias("_sx"), zero(F.count(x)).alias("_cx"),
        zero(F.sum(x * w)).alias("_swx"), zero(F.sum(w)).alias("_sw"))
    per_id = per_id.join(idx, [stratum, group, id_col]).select(
        stratum, group, "n", (F.col("idx") / CHUNK).cast("bigint").alias("_chunk"), "idx", "_sx", "_cx", "_swx", "_sw")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType([StructField("s", per_id.schema[stratum].dataType), StructField("g", per_id.schema[group].dataType),
                         StructField("sums", ArrayType(DoubleType()))])
    arrow = to_arrow_schema(schema)

    def resample(batches):
        def chunks():
            held, rows = None, []
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if row[:4] != held:
                        if rows:
                            yield held, rows
                        held, rows = row[:4], []
                    rows.append(row[4:])
            if rows:
                yield held, rows

        totals: dict = {}
        for (s, g, n, _), rows in chunks():
            at = np.array([r[0] for r in rows])
            counts = draw_counts(seed, s, g, n, int(at.min()), int(at.max()) + 1, n_boot)[:, at - at.min()]
            got = counts @ np.array([r[1:] for r in rows])
            totals[s, g] = totals[s, g] + got if (s, g) in totals else got
        if totals:
            yield pa.RecordBatch.from_pylist([{"s": s, "g": g, "sums": v.ravel()} for (s, g), v in totals.items()], schema=arrow)

    # one row for each task, stratum and group, with the sums of all replicates
    drawn = (per_id.repartition(parts, stratum, group, "_chunk").sortWithinPartitions(stratum, group, "_chunk")
             .mapInArrow(resample, schema))

    def add(batches):
        totals: dict = {}
        for batch in batches:
            for s, g, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                v = v.values.to_numpy(zero_copy_only=False)
                totals[s, g] = totals[s, g] + v if (s, g) in totals else v
        if totals:
            yield pa.RecordBatch.from_pylist([{"s": s, "g": g, "sums": v} for (s, g), v in totals.items()], schema=arrow)

    summed = drawn.repartition(parts, "s", "g").mapInArrow(add, schema)
    both = summed.groupBy("s").agg(*[F.max(F.when(F.col("g") == g, F.col("sums"))).alias(f"v{i}") for i, g in enumerate(groups)])
    rows = both.select(F.col("s").alias(stratum), F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))).alias("replicate"), "v0", "v1")

    def part(i, j):  # j: sum of values, their count, weighted sum, sum of weights
        return F.get(f"v{i}", 4 * F.col("replicate") + j)

    def mean(i):
        return F.try_divide(part(i, 0), part(i, 1))

    def wmean(i):
        return F.when(part(i, 3) != 0, part(i, 2) / part(i, 3))

    return rows.select(stratum, "replicate", (mean(0) - mean(1)).alias("diff_unweighted"),
                       (wmean(0) - wmean(1)).alias("diff_weighted"))


def bootstrap_ci(boot: DataFrame, stratum: str, cols: Sequence[str] = ("diff_unweighted", "diff_weighted"),
                 probs: Sequence[float] = (0.025, 0.5, 0.975)) -> DataFrame:
    """Mean and percentile interval per stratum, nulls ignored (M2)."""
    aggs = []
    for c in cols:
        q = F.percentile(F.col(c), F.array(*[F.lit(p) for p in probs]))
        aggs += [F.avg(c).alias(f"{c}_mean"), q.alias(f"_{c}_q")]
    out = boot.groupBy(stratum).agg(*aggs)
    sel = [stratum]
    for c in cols:
        sel.append(f"{c}_mean")
        for i, p in enumerate(probs):
            sel.append(F.col(f"_{c}_q")[i].alias(f"{c}_p{format(p * 100, 'g').replace('.', '_')}"))
    return out.select(*sel)
