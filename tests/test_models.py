import numpy as np
import pytest
from pyspark.sql import functions as F

from panelscope.operators import glm
from panelscope.operators import ordinal as od


def _numpy_logit(X, y, f):
    b = np.zeros(X.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-X @ b))
        g = X.T @ (f * (y - p))
        H = (X * (f * p * (1 - p))[:, None]).T @ X
        b = b + np.linalg.solve(H, g)
    return b


@pytest.fixture(scope="module")
def logit_data(spark):
    rng = np.random.default_rng(1)
    n = 400
    x = rng.normal(size=n)
    per = rng.integers(0, 3, size=n)
    eta = -0.3 + 0.8 * x + np.array([0, 0.5, -0.4])[per]
    y = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(float)
    f = rng.integers(1, 4, size=n).astype(float)
    rows = [(float(a), int(b), float(c), float(d)) for a, b, c, d in zip(x, per, y, f)]
    return spark.createDataFrame(rows, "x double, p int, y double, f double"), x, per, y, f


def test_logit_matches_independent_newton(spark, logit_data):
    df, x, per, y, f = logit_data
    X = np.column_stack([np.ones_like(x), x, per == 1, per == 2]).astype(float)
    for weight, fw in ((None, np.ones_like(f)), ("f", f)):
        fit = glm.fit_logit(df, "y", ["x"], ["p"], weight=weight)
        assert fit.converged
        np.testing.assert_allclose(fit.coef, _numpy_logit(X, y, fw), rtol=1e-9, atol=1e-10)
        assert fit.max_score < 1e-6                                   # T7


def test_frequency_weight_equals_repetition(spark, logit_data):
    df, *_ = logit_data
    a = glm.fit_logit(df, "y", ["x"], ["p"], weight="f")
    rep = df.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("f").cast("int")))).drop("k")
    b = glm.fit_logit(rep, "y", ["x"], ["p"])
    np.testing.assert_allclose(a.coef, b.coef, rtol=1e-9)            # T8
    # the replication convention of HC1 equals the HC1 of the repeated rows
    c = glm.fit_logit(df, "y", ["x"], ["p"], weight="f")
    np.testing.assert_allclose(np.diag(c.cov), np.diag(b.cov), rtol=1e-8)


def test_hc1_per_row_scores(spark, logit_data):
    df, x, per, y, f = logit_data
    X = np.column_stack([np.ones_like(x), x, per == 1, per == 2]).astype(float)
    fit = glm.fit_logit(df, "y", ["x"], ["p"], weight="f", hc1="score_rows")
    p = 1 / (1 + np.exp(-X @ fit.coef))
    bread = np.linalg.inv((X * (f * p * (1 - p))[:, None]).T @ X)
    s = X * (f * (y - p))[:, None]
    want = bread @ (s.T @ s) @ bread * len(y) / (f.sum() - X.shape[1])
    np.testing.assert_allclose(fit.cov, want, rtol=1e-8)
    u = glm.fit_logit(df, "y", ["x"], ["p"])                      # f = 1: both conventions agree
    v = glm.fit_logit(df, "y", ["x"], ["p"], hc1="score_rows")
    np.testing.assert_allclose(u.cov, v.cov, rtol=1e-10)


def test_odds_table(spark, logit_data):
    df, *_ = logit_data
    t = {r.term: r for r in glm.fit_logit(df, "y", ["x"], ["p"]).table(spark).collect()}
    r = t["x"]
    assert abs(r.odds_ratio - np.exp(r.estimate)) < 1e-12
    assert r.ci_low < r.odds_ratio < r.ci_high


@pytest.fixture(scope="module")
def ordinal_data(spark):
    rng = np.random.default_rng(5)
    n = 3000
    x1, x2 = rng.normal(size=n), rng.uniform(0, 10, size=n)
    beta = np.array([0.9, -0.2])
    theta = np.array([-2.5, -1.0, 0.3, 1.5])
    eta = beta[0] * x1 + beta[1] * x2
    u = rng.logistic(size=n)
    y = np.searchsorted(theta, eta + u)             # P(Y<=j) = F(theta_j - eta)
    rows = [(float(a), float(b), int(c)) for a, b, c in zip(x1, x2, y)]
    return spark.createDataFrame(rows, "x1 double, x2 double, y int"), beta, theta


def test_ordered_logit_recovers_parameters(spark, ordinal_data):
    df, beta, theta = ordinal_data
    m = od.fit_ordered_logit(df, "y", ["x1", "x2"], [0, 1, 2, 3, 4])
    assert m.converged and m.grad_norm < 1e-5                      # T7
    assert np.all(np.diff(m.thresholds) > 0)                        # T9
    se = np.sqrt(np.diag(m.cov))
    est = np.r_[m.thresholds, m.coefs]
    assert np.all(np.abs(est - np.r_[theta, beta]) < 4 * se)
    probs = df.select(m.probabilities().alias("p")).select(F.aggregate("p", F.lit(0.0), lambda a, b: a + b).alias("s"))
    assert probs.agg(F.max(F.abs(F.col("s") - 1))).first()[0] < 1e-12      # T9
    ex = df.select(m.expected().alias("e")).agg(F.min("e"), F.max("e")).first()
    assert 0 <= ex[0] and ex[1] <= 4                                # T6


def test_two_levels_agree_with_binomial(spark, logit_data):
    df, *_ = logit_data
    m = od.fit_ordered_logit(df.withColumn("yi", F.col("y").cast("int")), "yi", ["x"], [0, 1])
    b = glm.fit_logit(df, "y", ["x"], [])
    # P(Y=1) = 1 - F(theta - x b)  <=>  logit with intercept -theta, slope b
    assert abs(m.coefs[0] - b.coef[1]) < 1e-7 and abs(-m.thresholds[0] - b.coef[0]) < 1e-7


def test_model_sample_rule(spark):
    rows = [(1, 2.0, 1.0, None), (2, 3.0, 1.0, 0.5), (3, 4.0, None, 10.0), (4, 3.0, 2.0, 100.0), (5, 4.0, 1.0, 20.0)]
    df = spark.createDataFrame(rows, "e int, r double, a double, size double").withColumn("period", F.lit(1))
    s, levels, periods = od.model_sample(df, "r", ["a"], "size", "period", checkpoint=False)
    got = {r.e: (r.size, r.level_index) for r in s.collect()}
    assert levels == [2.0, 3.0, 4.0] and periods == [1]
    assert got == {1: (1.0, 0), 2: (1.0, 1), 4: (100.0, 1), 5: (20.0, 2)}
    with pytest.raises(ValueError):
        od.model_sample(df.filter("r < 4"), "r", ["a"], "size", "period", checkpoint=False)


def _classes(spark, separated):
    rng = np.random.default_rng(5)
    n = 600
    x, z = rng.normal(size=n), rng.normal(size=n) * 30 + 100
    eta = np.column_stack([np.zeros(n), 0.4 + 0.9 * x, -0.5 - 0.7 * x + 0.01 * (z - 100)])
    p = np.exp(eta)
    y = (rng.random(n)[:, None] > np.cumsum(p / p.sum(axis=1, keepdims=True), axis=1)).sum(axis=1)
    w = (y == 2).astype(float) * (rng.random(n) < 0.3) if separated else rng.integers(0, 2, n).astype(float)
    rows = [(int(a), float(b), float(c), float(d)) for a, b, c, d in zip(y, x, z, w)]
    return spark.createDataFrame(rows, "y int, x double, z double, w double").repartition(3), y, np.column_stack([np.ones(n), x, z, w])


def test_multinomial_matches_independent_newton(spark):
    df, y, X = _classes(spark, separated=False)
    fit = glm.fit_multinomial(df, "y", ["x", "z", "w"])
    assert fit.converged and fit.separated == [False, False] and fit.max_score < 1e-8
    eta = np.column_stack([np.zeros(len(X)), X @ fit.coef.T])
    P = np.exp(eta) / np.exp(eta).sum(axis=1, keepdims=True)
    np.testing.assert_allclose(((y[:, None] == [1, 2]) - P[:, 1:]).T @ X, 0, atol=1e-4)  # the maximum is where the scores vanish
    H = np.block([[X.T @ (X * (P[:, [a]] * ((a == b) - P[:, [b]]))) for b in (1, 2)] for a in (1, 2)])
    np.testing.assert_allclose(np.sqrt(np.diag(fit.cov)), np.sqrt(np.diag(np.linalg.inv(H))), rtol=1e-6)
    ml = np.log(P[np.arange(len(y)), y]).sum()
    assert abs(fit.loglik - ml) < 1e-6 and fit.n_rows == 600


def test_multinomial_tells_a_separated_class(spark):
    """w = 1 only where y = 2: its coefficient there has no maximum."""
    df, y, X = _classes(spark, separated=True)
    fit = glm.fit_multinomial(df, "y", ["x", "z", "w"])
    assert fit.converged and fit.separated[1] and fit.iterations < 100
    rows = {(r["class"], r["term"]): r for r in fit.table(spark).collect()}
    assert rows[(2, "w")]["separated"] and rows[(2, "w")]["std_error"] is None
    eta = np.column_stack([np.zeros(len(X)), X @ fit.coef.T])
    P = np.exp(eta - eta.max(axis=1, keepdims=True))
    P /= P.sum(axis=1, keepdims=True)
    np.testing.assert_allclose(P[:, 1:].T @ X, (y[:, None] == [1, 2]).T @ X, rtol=1e-5, atol=1e-6)  # fitted sums equal observed ones
