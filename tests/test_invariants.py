"""Invariants of SURVEY section 5 on the pipeline over the sf0.001 tables."""

import math

from pyspark.sql import functions as F

from conftest import SF001
from panelscope.operators import exposure as ex
from panelscope.plans import panel as P


def test_t1_weights_sum_to_one(spark):
    w = P.share_weights(spark, SF001)
    bad = w.groupBy(*P.KEYS).agg(F.sum("weight").alias("s")).filter(F.abs(F.col("s") - 1) > 1e-12).count()
    assert bad == 0


def test_t2_coverage_plus_missing_share_is_one_without_null_values(spark):
    j = P.rate_joined(spark, SF001)
    # keep only entity-periods where no matched unit has a null value
    nulls = j.filter((F.col(ex.MATCHED) == 1) & F.col("rate").isNull()).select(*P.KEYS).distinct()
    clean = j.join(nulls, P.KEYS, "left_anti")
    cov = ex.exposure(clean, P.KEYS, "rate", "x")
    ms = ex.missing_share(clean, P.KEYS)
    both = cov.join(ms, P.KEYS)
    assert both.count() > 0
    assert both.filter(F.abs(F.col("coverage_weight_share") + F.col("missing_share") - 1) > 1e-9).count() == 0


def test_t3_band_filter(spark):
    n = P.near_threshold(spark, SF001)
    r = n.agg(F.min("rating"), F.max("rating"), F.sum(F.col("out_of_scope")), F.count("rate_exposure"),
              F.count(F.lit(1))).first()
    assert r[0] >= 3.5 and r[1] <= 4.5 and r[2] == 0 and r[3] == r[4]


def test_t4_concentration_bounds(spark):
    c = P.concentration(spark, SF001).collect()
    assert c
    for r in c:
        n = r.n_units
        assert 1 / n - 1e-12 <= r.hhi <= 1 + 1e-12
        assert -1e-12 <= r.entropy <= math.log(n) + 1e-12
        assert r.top1_share <= r.top5_share + 1e-12 <= 1 + 2e-12


def test_fused_features_equal_separate_operators(spark):
    fused = P.unit_features(spark, SF001)
    sep = (P.rate_exposure(spark, SF001).select(*P.KEYS, "rate_exposure")
           .join(P.static_exposure(spark, SF001).select(*P.KEYS, "static_exposure"), P.KEYS)
           .join(P.score_exposure(spark, SF001).select(*P.KEYS, "score_exposure"), P.KEYS)
           .join(P.concentration(spark, SF001), P.KEYS))
    cols = ["rate_exposure", "static_exposure", "score_exposure", "hhi", "entropy", "top1_share", "top5_share"]
    a = {tuple(r[k] for k in P.KEYS): r for r in fused.collect()}
    b = {tuple(r[k] for k in P.KEYS): r for r in sep.collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in cols:
            x, y = a[k][c], b[k][c]
            assert (x is None and y is None) or abs(x - y) < 1e-12, (k, c, x, y)
