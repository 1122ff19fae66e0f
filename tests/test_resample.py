import math

import numpy as np
from pyspark.sql import functions as F

from panelscope.operators import resample as rs


def _data(spark, n_low, n_high, period=1):
    rows = [(period, "L", f"a{i}", float(i), 1 + i) for i in range(n_low)]
    rows += [(period, "H", f"b{i}", float(10 + i), 2) for i in range(n_high)]
    return spark.createDataFrame(rows, "p int, band string, id string, x double, w bigint")


def test_small_stratum_skipped(spark):
    assert rs.bootstrap_diff(_data(spark, 4, 9), "p", "band", "id", "x", "w", ("L", "H"), n_boot=20).count() == 0
    assert rs.bootstrap_diff(_data(spark, 5, 9), "p", "band", "id", "x", "w", ("L", "H"), n_boot=20).count() == 20


def test_draw_count_and_determinism(spark):
    df = _data(spark, 7, 6)
    a = rs.bootstrap_diff(df, "p", "band", "id", "x", "w", ("L", "H"), n_boot=50, seed=3)
    b = rs.bootstrap_diff(df.repartition(5), "p", "band", "id", "x", "w", ("L", "H"), n_boot=50, seed=3, buckets=3)
    ra = sorted(tuple(r) for r in a.collect())
    rb = sorted(tuple(r) for r in b.collect())
    assert len(ra) == 50
    # same seed -> same draws, whatever the partitioning (index order differs
    # with the bucket count, so compare the distribution of the means)
    a2 = rs.bootstrap_diff(df.repartition(3), "p", "band", "id", "x", "w", ("L", "H"), n_boot=50, seed=3)
    assert ra == sorted(tuple(r) for r in a2.collect())
    assert len(rb) == 50


def test_dense_index_is_a_permutation(spark):
    df = spark.range(0, 500).select((F.col("id") % 3).alias("s"), F.col("id").cast("string").alias("id"))
    idx = rs.dense_index(df, ["s"], "id", buckets=7)
    for r in idx.groupBy("s").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"),
                                  F.countDistinct("idx").alias("k"), F.max("n").alias("n")).collect():
        assert (r.lo, r.hi, r.k) == (0, r.n - 1, r.n)


def test_ci(spark):
    df = _data(spark, 8, 8)
    ci = rs.bootstrap_ci(rs.bootstrap_diff(df, "p", "band", "id", "x", "w", ("L", "H"), n_boot=200), "p").first()
    assert ci.diff_unweighted_p2_5 <= ci.diff_unweighted_p50 <= ci.diff_unweighted_p97_5
    assert abs(ci.diff_unweighted_mean - (3.5 - 13.5)) < 1.5


def test_binomial_numbers_are_the_quantiles_of_the_law():
    rng = np.random.default_rng(3)
    for n, part, whole in ((1, 1, 2), (7, 3, 5), (40, 1, 40), (500, 250, 501)):
        p = part / whole
        law = np.cumsum([math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(n + 1)])
        u = rng.random(500)
        got = rs.binomial(np.full(500, n), part, whole, u)
        assert (got == np.minimum(np.searchsorted(law, u), n)).all()
    # far from zero: mean and deviation of a large split
    x = rs.binomial(np.full(4000, 10 ** 7), 1, 3, rng.random(4000))
    assert abs(x.mean() - 10 ** 7 / 3) < 200 and abs(x.std() / math.sqrt(10 ** 7 * 2 / 9) - 1) < 0.05


def test_counts_of_parts_agree_and_follow_the_multinomial_law():
    n, boots = 37, 3000
    whole = rs.draw_counts(9, 1997, "L", n, 0, n, boots)
    assert (whole.sum(axis=1) == n).all()
    for first, last in ((0, 1), (5, 20), (36, 37)):
        assert (rs.draw_counts(9, 1997, "L", n, first, last, boots) == whole[:, first:last]).all()
    assert np.abs(whole.mean(axis=0) - 1).max() < 0.1
    assert np.abs(whole.var(axis=0) - (1 - 1 / n)).max() < 0.2
    cov = np.cov(whole.T)[~np.eye(n, dtype=bool)]
    assert abs(cov.mean() + 1 / n) < 0.002
    assert not (rs.draw_counts(10, 1997, "L", n, 0, n, 50) == whole[:50]).all()


def test_what_is_shuffled_does_not_grow_with_the_replicates(spark):
    df = _data(spark, 30, 30)
    plans = [rs.bootstrap_diff(df, "p", "band", "id", "x", "w", ("L", "H"), n_boot=n) for n in (10, 1000)]
    for out, n in zip(plans, (10, 1000)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Generate explode") < plan.index("Exchange")  # replicates become rows after the last shuffle
        assert out.count() == n
