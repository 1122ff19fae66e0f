"""Binomial logit with period effects, frequency weights, HC1 robust
covariance and odds ratios (M3-M7); multinomial logit with a test for
separation (M9).

The binomial fit is iteratively reweighted least squares written as
data-parallel Newton: each step is one global aggregate of the gradient
X'f(y-p) and the information X'f p(1-p) X (k + k(k+1)/2 sums, combined
map-side), solved on the driver (k x k).  The sandwich "meat"
sum f (y-p)^2 x x' is one more aggregate at the optimum.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .moments import sum_kernel
from .ordinal import sorted_levels, sql_double


@dataclass
class LogitFit:
    terms: list[str]
    coef: np.ndarray
    cov: np.ndarray
    n_rows: int
    sum_weights: float
    iterations: int
    converged: bool
    max_score: float

    def table(self, spark: SparkSession, z: float = 1.96) -> DataFrame:
        """(term, estimate, std_error, z_value, odds_ratio, ci_low, ci_high)
        and the state of the fit: converged, iterations, max_score (M7)."""
        se = np.sqrt(np.clip(np.diag(self.cov), 0, None))
        rows = [(t, float(b), float(s), float(b / s) if s > 0 else None, float(np.exp(b)),
                 float(np.exp(b - z * s)), float(np.exp(b + z * s)), self.converged, self.iterations, self.max_score)
                for t, b, s in zip(self.terms, self.coef, se)]
        return spark.createDataFrame(rows, "term string, estimate double, std_error double, z_value double, "
                                           "odds_ratio double, ci_low double, ci_high double, "
                                           "converged boolean, iterations int, max_score double")


def design(df: DataFrame, features: Sequence[str], categorical: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Intercept, numeric features and treatment-coded categoricals (first
    level dropped, as ``C(period)``).  Rows with a null term are dropped."""
    df = df.dropna(subset=[*features, *categorical])
    cols, terms = [F.lit(1.0).alias("_x0")], ["Intercept"]
    for i, f in enumerate(features):
        cols.append(F.col(f).cast("double").alias(f"_x{len(terms)}"))
        terms.append(f)
    for c in categorical:
        for lv in sorted_levels(df, c)[1:]:
            cols.append(F.when(F.col(c) == lv, 1.0).otherwise(0.0).alias(f"_x{len(terms)}"))
            terms.append(f"C({c})[T.{lv}]")
    return df.select("*", *cols), terms


def fit_logit(df: DataFrame, outcome: str, features: Sequence[str], categorical: Sequence[str] = (),
              weight: str | None = None, max_iter: int = 50, tol: float = 1e-10,
              hc1: str = "replicate") -> LogitFit:
    """Maximum-likelihood logit; ``weight`` is a frequency weight f.

    HC1 covariance = bread . meat . bread x correction, bread the inverse
    information sum f p(1-p) x x'.  Two conventions for weighted fits (they
    agree when f = 1):

    * ``"replicate"`` (default): meat = sum f (y-p)^2 x x', correction
      sum f / (sum f - k) -- identical to repeating each row f times;
    * ``"score_rows"``: each row's score f (y-p) x is one observation,
      meat = sum f^2 (y-p)^2 x x', correction n_rows / (sum f - k)."""
    # the model rows are written once; the level lookup and every Newton
    # step read them
    keep = [outcome, *features, *categorical] + ([weight] if weight else [])
    rows = materialize(df.select(*dict.fromkeys(keep)).dropna(subset=[*features, *categorical]), "logit")
    X, terms = design(rows, features, categorical)
    k = len(terms)
    f = F.col(weight).cast("double") if weight else F.lit(1.0)
    data = X.select(F.col(outcome).cast("double").alias("_y"), f.alias("_f"),
                    *[F.col(f"_x{i}") for i in range(k)])
    spark = df.sparkSession
    xs = [f"_x{i}" for i in range(k)]
    beta = np.zeros(k)

    def moments(b: np.ndarray, meat: str | None = None):
        # every expression is SQL text with the parameters as exact
        # literals: building a step is one JVM call however many terms
        eta = " + ".join(f"{sql_double(v)} * {x}" for v, x in zip(b, xs))
        step = data.selectExpr("_y", "_f", *xs, f"1D / (1D + exp(-({eta}))) AS _p")
        wexpr = {"score_rows": "_f * _f * (_y - _p) * (_y - _p)", "replicate": "_f * (_y - _p) * (_y - _p)",
                 None: "_f * _p * (1D - _p)"}[meat]
        step = step.selectExpr(*xs, "_f * (_y - _p) AS _g", f"{wexpr} AS _w", "_f")
        sums = ["count(1) AS n", "sum(_f) AS sf"] + [f"sum(_g * {x}) AS g{i}" for i, x in enumerate(xs)]
        sums += [f"sum(_w * {xs[i]} * {xs[j]}) AS h{i}_{j}" for i in range(k) for j in range(i, k)]
        view = f"_panelscope_logit_{uuid.uuid4().hex}"
        step.createOrReplaceTempView(view)
        try:
            row = spark.sql(f"SELECT {', '.join(sums)} FROM {view}").first()
        finally:
            spark.catalog.dropTempView(view)
        g = np.array([row[f"g{i}"] for i in range(k)])
        H = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                H[i, j] = H[j, i] = row[f"h{i}_{j}"]
        return g, H, row["n"], row["sf"]

    it, converged = 0, False
    g, H, n, sf = moments(beta)
    while it < max_iter:
        it += 1
        delta = np.linalg.lstsq(H, g, rcond=None)[0]
        # step control: no term of the linear predictor moves by more than 10 a step
        delta = delta * min(1.0, 10.0 / max(float(np.max(np.abs(delta))), 1e-300))
        beta = beta + delta
        g, H, n, sf = moments(beta)
        if np.max(np.abs(delta)) < tol * (1 + np.max(np.abs(beta))):
            converged = True
            break
    if hc1 not in ("score_rows", "replicate"):
        raise ValueError(f"unknown HC1 convention: {hc1}")
    bread = np.linalg.pinv(H)
    _, meat, _, _ = moments(beta, meat=hc1)
    correction = (n if hc1 == "score_rows" else sf) / (sf - k)
    cov = bread @ meat @ bread * correction
    return LogitFit(terms, beta, cov, int(n), float(sf), it, converged, float(np.max(np.abs(g))))


@dataclass
class MultinomialFit:
    """Baseline-coded multinomial logit: class 0 has zero coefficients."""

    terms: list[str]
    coef: np.ndarray            # (classes - 1, terms)
    cov: np.ndarray             # of coef, class by class
    loglik: float
    n_rows: int
    iterations: int
    converged: bool
    separated: list[bool]       # for each class but the baseline
    max_score: float

    def table(self, spark: SparkSession) -> DataFrame:
        """(class, term, coefficient, std_error) and the state of the fit:
        converged, separated (of the class), iterations, max_score.  In a
        separated class no maximum exists: its coefficients grow without bound
        and stand where the score had vanished, its errors are null."""
        se = np.sqrt(np.clip(np.diag(self.cov), 0, None)).reshape(self.coef.shape)
        rows = [(k + 1, t, float(self.coef[k, i]), None if self.separated[k] else float(se[k, i]), self.converged, self.separated[k],
                 self.iterations, self.max_score) for k in range(len(self.coef)) for i, t in enumerate(self.terms)]
        return spark.createDataFrame(rows, "class int, term string, coefficient double, std_error double, converged boolean, "
                                           "separated boolean, iterations int, max_score double")


def fit_multinomial(df: DataFrame, outcome_index: str, features: Sequence[str], classes: int | None = None, max_iter: int = 200,
                    tol: float = 1e-8) -> MultinomialFit:
    """Maximum-likelihood multinomial logit with intercept (M9), class 0 the
    baseline.

    Newton steps over the blocks of class x term sums, one pass of
    :func:`sum_kernel` each; features are standardised for conditioning.  The
    fit has converged when every class and term's score is within ``tol`` of
    the sum of its absolute contributions, and the step no longer moves unless
    a class is separated.

    Separation: if the last step still moves some class, it is tested on all
    rows whether its direction raises no other class's predictor over that of
    the observed class and raises the observed one somewhere.  Then the
    likelihood has no maximum, and the classes the direction moves are
    ``separated``.  Rows with a null are dropped; a class without rows is
    separated, too."""
    data = materialize(df.select(F.col(outcome_index).alias("_y"), *features).dropna(), "multinomial")
    cols, p = ["_y", *features], len(features) + 1
    K = classes or (data.agg(F.max("_y")).first()[0] or 0) + 1

    def scale(m):
        return np.concatenate([[len(m)], m[:, 1:].sum(axis=0), (m[:, 1:] ** 2).sum(axis=0)])

    s = sum_kernel(data, cols, scale, 2 * p - 1)
    n = s[0]
    if not n or K < 2:
        raise ValueError("a multinomial fit needs rows of two classes or more")
    mu = s[1:p] / n
    sd = np.sqrt(np.clip(s[p:] / n - mu * mu, 0, None))
    sd[~(sd > 1e-12 * np.maximum(1.0, np.abs(mu)))] = 1.0
    pairs = [(k, m) for k in range(K - 1) for m in range(k, K - 1)]

    def design_of(m):
        return np.column_stack([np.ones(len(m)), (m[:, 1:] - mu) / sd]), m[:, 0].astype(np.int64)

    def evaluate(B):
        def kernel(m):
            X, y = design_of(m)
            eta = np.column_stack([np.zeros(len(X)), X @ B.T])
            eta -= eta.max(axis=1, keepdims=True)
            P = np.exp(eta)
            total = P.sum(axis=1)
            ll = (eta[np.arange(len(y)), y] - np.log(total)).sum()
            P = (P / total[:, None])[:, 1:]
            R = (y[:, None] == np.arange(1, K)) - P
            blocks = [(X.T @ (X * (P[:, [k]] * ((k == m_) - P[:, [m_]])))).ravel() for k, m_ in pairs]
            return np.concatenate([[ll], (R.T @ X).ravel(), (np.abs(R).T @ np.abs(X)).ravel(), *blocks])

        v = sum_kernel(data, cols, kernel, 1 + 2 * (K - 1) * p + len(pairs) * p * p)
        g, size = v[1:1 + (K - 1) * p], v[1 + (K - 1) * p:1 + 2 * (K - 1) * p]
        H = np.zeros(((K - 1) * p, (K - 1) * p))
        for (k, m_), block in zip(pairs, v[1 + 2 * (K - 1) * p:].reshape(-1, p, p)):
            H[k * p:(k + 1) * p, m_ * p:(m_ + 1) * p] = block
            H[m_ * p:(m_ + 1) * p, k * p:(k + 1) * p] = block.T
        return v[0], g, size, H

    B = np.zeros((K - 1, p))
    ll, g, size, H = evaluate(B)
    it, converged, step = 0, False, np.zeros_like(B)
    while it < max_iter:
        it += 1
        full = (np.linalg.pinv(H, rcond=1e-14, hermitian=True) @ g).reshape(B.shape)
        step = full * min(1.0, 5.0 / max(float(np.abs(full).max()), 1e-300))
        ll_new, g_new, size_new, H_new = evaluate(B + step)
        while not ll_new >= ll - 1e-12 * abs(ll) and np.abs(step).max() > 1e-10:
            step = step / 2
            ll_new, g_new, size_new, H_new = evaluate(B + step)
        B, ll, g, size, H = B + step, ll_new, g_new, size_new, H_new
        small = np.abs(g).max() <= tol * max(1.0, n)
        if small and (np.abs(step).max() <= 1e-6 or np.abs(g).max() <= tol * 1e-2):
            converged = True
            break
    separated = [False] * (K - 1)
    if np.abs(step).max() > 1e-6:
        D = step / np.abs(step).max()

        def against(m):
            X, y = design_of(m)
            eta = np.column_stack([np.zeros(len(X)), X @ D.T])
            gain = eta[np.arange(len(y)), y][:, None] - eta
            return np.array([(gain.min(axis=1) < -1e-3).sum(), (gain.max(axis=1) > 1e-3).sum()], dtype=float)

        falls, rises = sum_kernel(data, cols, against, 2)
        if not falls and rises:
            separated = (np.abs(D).max(axis=1) > 1e-3).tolist()
    # back to the original scale
    coef = B / np.concatenate([[1.0], sd])
    coef[:, 0] -= (B[:, 1:] * (mu / sd)).sum(axis=1)
    J = np.diag(np.concatenate([[1.0], 1 / sd]))
    J[0, 1:] = -mu / sd
    J = np.kron(np.eye(K - 1), J)
    cov = J @ np.linalg.pinv(H, rcond=1e-14, hermitian=True) @ J.T
    return MultinomialFit(["const", *features], coef, cov, float(ll), int(n), it, converged, separated,
                          float((np.abs(g) / np.maximum(size, 1.0)).max()))
