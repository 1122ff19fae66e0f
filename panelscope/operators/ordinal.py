"""Model sample, ordered logit, class probabilities, expected level and the
observed = expected + residual decomposition (M8, M10-M12, M14, P29-P31).

The fit is a data-parallel Newton method: each step is ONE grouped aggregate
over the sample (grouped by the observed class, so at most K rows leave each
task and the shuffle is K rows), returning log-likelihood, gradient and
Hessian sums computed with built-in column expressions.  Only the
(K-1+p) x (K-1+p) system is solved on the driver.  The sample is
checkpointed once before iterating.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import clip_lower, inf_to_null
from ..session import materialize
from .moments import sum_kernel

def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


# ------------------------------------------------------------------ sample

def sorted_levels(df: DataFrame, col: str) -> list:
    """Distinct sorted values of a column whose levels become model columns
    (O6, U3): the levels alone reach the driver."""
    return [r[0] for r in df.select(col).distinct().orderBy(col).collect()]


def model_sample(frame: DataFrame, outcome: str, core: Sequence[str], size: str, period: str,
                 min_levels: int = 3, checkpoint: bool = True,
                 index_levels: bool = True) -> tuple[DataFrame, list | None, list | None]:
    """The reference's model-row rule (M14):
    drop rows missing the outcome or a core feature; size: null -> 1, floor
    1, natural log; outcome -> index of its sorted level (P31); inf -> null
    and drop.  Returns (sample, outcome levels, periods)."""
    need = [outcome, *core]
    df = frame.dropna(subset=need)
    df = df.withColumn(size, clip_lower(size, 1.0, fill=1.0)).withColumn("log_size", F.log(F.col(size)))
    for c in [*core, "log_size"]:
        df = df.withColumn(c, inf_to_null(F.col(c).cast("double")))
    df = df.dropna(subset=[*core, "log_size"])
    if checkpoint:
        # the sample is read by the level lookups, every Newton step and the
        # decomposition: materialise it once in the shared checkpoint folder
        df = materialize(df, "model_sample")
    if not index_levels:            # scoring at given parameters needs no level lookup
        return df, None, None
    # both level lists from one distinct job: each level becomes a model column
    pairs = df.select(outcome, period).distinct().collect()
    levels = sorted({r[0] for r in pairs})
    periods = sorted({r[1] for r in pairs if r[1] is not None})
    if len(levels) < min_levels:
        raise ValueError(f"need at least {min_levels} outcome levels, found {levels}")
    idx = F.array_position(F.array(*[F.lit(float(v)) for v in levels]), F.col(outcome).cast("double")) - 1
    return df.withColumn("level_index", idx.cast("int")), levels, periods


def period_dummies(df: DataFrame, period: str, periods: Sequence) -> tuple[DataFrame, list[str]]:
    """One 0/1 column per period but the lowest (P30, ``drop_first``)."""
    names = []
    for p in list(periods)[1:]:
        n = f"{period}_{p}"
        df = df.withColumn(n, F.when(F.col(period) == p, 1.0).otherwise(0.0))
        names.append(n)
    return df, names


# ------------------------------------------------------------------ model

@dataclass
class OrderedLogit:
    """Fitted cumulative-logit model: P(Y <= j) = sigmoid(theta_j - x.beta)."""

    levels: list[float]
    features: list[str]
    thresholds: list[float]
    coefs: list[float]
    cov: np.ndarray | None = None
    loglik: float = float("nan")
    iterations: int = 0
    converged: bool = False
    grad_norm: float = float("nan")
    extra: dict = field(default_factory=dict)

    def eta(self) -> Column:
        e = F.lit(0.0)
        for f, b in zip(self.features, self.coefs):
            e = e + F.lit(float(b)) * F.col(f)
        return e

    def cumulative(self) -> list[Column]:
        eta = self.eta()
        return [sigmoid(F.lit(float(t)) - eta) for t in self.thresholds]

    def probabilities(self) -> Column:
        """Array of the K class probabilities."""
        cum = self.cumulative()
        ps = [cum[0]] + [cum[j] - cum[j - 1] for j in range(1, len(cum))] + [F.lit(1.0) - cum[-1]]
        return F.array(*ps)

    def expected(self) -> Column:
        """Expected level, telescoped: level_K - sum_j (level_{j+1}-level_j) F_j."""
        cum = self.cumulative()
        e = F.lit(float(self.levels[-1]))
        for j, c in enumerate(cum):
            e = e - F.lit(float(self.levels[j + 1] - self.levels[j])) * c
        return e

    def params_rows(self) -> list[tuple]:
        se = (np.sqrt(np.clip(np.diag(self.cov), 0, None)) if self.cov is not None
              else [float("nan")] * (len(self.thresholds) + len(self.coefs)))
        rows = []
        for j, t in enumerate(self.thresholds):
            rows.append((f"{self.levels[j]}/{self.levels[j + 1]}", "threshold", float(t), float(se[j])))
        k = len(self.thresholds)
        for i, (f, b) in enumerate(zip(self.features, self.coefs)):
            rows.append((f, "slope", float(b), float(se[k + i])))
        return rows


def sql_double(v: float) -> str:
    """A double literal for SQL text that round-trips exactly."""
    return f"CAST({float(v)!r} AS DOUBLE)"


def _step_kernel(theta: np.ndarray, beta: np.ndarray, mu: np.ndarray, sd: np.ndarray):
    """Log-likelihood, score and information of a batch of (y, features) rows
    at the given parameters, as one vector."""
    K, p = len(theta) + 1, len(beta)
    m = K - 1 + p
    cuts = np.concatenate([[-np.inf], theta, [np.inf]])

    def sigmoid_of(v):
        out = np.exp(-np.abs(v))
        return np.where(v >= 0, 1 / (1 + out), out / (1 + out))

    def kernel(rows):
        y, Z = rows[:, 0].astype(np.int64), (rows[:, 1:] - mu) / sd
        eta = Z @ beta
        up, low = cuts[y + 1] - eta, cuts[y] - eta
        Fa, Fb = sigmoid_of(up), sigmoid_of(low)
        # probability of the observed class, written to avoid 1 - 1 cancellation
        P = np.where(y == K - 1, sigmoid_of(-low), np.where(y == 0, Fa, Fa - Fb))
        P = np.maximum(P, 1e-300)
        ga, gb = Fa * (1 - Fa) / P, -Fb * (1 - Fb) / P
        haa, hbb, hab = ga * (1 - 2 * Fa) - ga * ga, gb * (1 - 2 * Fb) - gb * gb, -ga * gb
        classes = (y[:, None] == np.arange(K)).astype(float)  # upper cut y, lower cut y - 1
        upper, lower = classes[:, :K - 1], classes[:, 1:]
        g = np.concatenate([ga @ upper + gb @ lower, -(ga + gb) @ Z])
        H = np.zeros((m, m))
        H[:K - 1, :K - 1] = np.diag(haa @ upper + hbb @ lower)
        both = hab @ classes
        for k in range(1, K - 1):
            H[k, k - 1] = H[k - 1, k] = both[k]
        side = upper.T @ (Z * -(haa + hab)[:, None]) + lower.T @ (Z * -(hab + hbb)[:, None])
        H[:K - 1, K - 1:], H[K - 1:, :K - 1] = side, side.T
        H[K - 1:, K - 1:] = Z.T @ (Z * (haa + 2 * hab + hbb)[:, None])
        return np.concatenate([[np.log(P).sum()], g, H.ravel()])

    return kernel


def fit_ordered_logit(sample: DataFrame, outcome_index: str, features: Sequence[str], levels: Sequence[float],
                      max_iter: int = 100, tol: float = 1e-9, checkpoint: bool = False) -> OrderedLogit:
    """Maximum-likelihood cumulative logit, no intercept, K-1 thresholds (M8).

    A Newton step is one pass over Arrow batches: each task adds up the score
    and the information of its rows as matrices (:func:`sum_kernel`), so many
    terms are one kernel, not thousands of SQL sums.

    Features are standardised for conditioning; estimates are returned on
    the original scale (thresholds shifted, slopes rescaled, covariance
    transformed with the Jacobian)."""
    K, p = len(levels), len(features)
    data = sample.select(F.col(outcome_index).alias("y"), *[F.col(c).cast("double").alias(c) for c in features])
    if checkpoint:
        data = materialize(data)
    # class counts and feature scaling from one grouped job; the scaling only
    # conditions the Newton system, the optimum does not depend on it
    per_class = data.groupBy("y").agg(F.count(F.lit(1)).alias("n"),
                                      *[F.sum(c).alias(f"s1_{i}") for i, c in enumerate(features)],
                                      *[F.sum(F.col(c) * F.col(c)).alias(f"s2_{i}") for i, c in enumerate(features)]
                                      ).collect()
    counts = {r["y"]: r["n"] for r in per_class}
    n_all = float(sum(counts.values()))
    mu = np.array([sum(r[f"s1_{i}"] for r in per_class) / n_all for i in range(p)], dtype=float)
    var = np.array([sum(r[f"s2_{i}"] for r in per_class) / n_all for i in range(p)], dtype=float) - mu * mu
    sd = np.sqrt(np.clip(var, 0.0, None))
    sd[~(sd > 1e-12 * np.maximum(1.0, np.abs(mu)))] = 1.0
    n = sum(counts.values())
    cum = np.cumsum([counts.get(k, 0) for k in range(K)])[:-1] / n
    cum = np.clip(cum, 1e-6, 1 - 1e-6)
    theta = np.log(cum / (1 - cum))
    beta = np.zeros(p)

    def evaluate(th, be):
        m = K - 1 + p
        v = sum_kernel(data, ["y", *features], _step_kernel(th, be, mu, sd), 1 + m + m * m)
        return v[0], v[1:1 + m], v[1 + m:].reshape(m, m)

    ll, g, H = evaluate(theta, beta)
    it, converged = 0, False
    while it < max_iter:
        it += 1
        try:
            step = np.linalg.solve(H, -g)
        except np.linalg.LinAlgError:
            step = -np.linalg.pinv(H) @ g
        t = 1.0
        while True:
            th_new, be_new = theta + t * step[:K - 1], beta + t * step[K - 1:]
            if np.all(np.diff(th_new) > 0):
                ll_new, g_new, H_new = evaluate(th_new, be_new)
                if np.isfinite(ll_new) and ll_new >= ll - 1e-12 * abs(ll):
                    break
            t /= 2.0
            if t < 1e-10:
                break
        if t < 1e-10:       # no step along this direction improves: report where it stands
            converged = bool(np.max(np.abs(g)) < 1e-6)
            break
        done = abs(ll_new - ll) <= tol * max(1.0, abs(ll)) and np.max(np.abs(g_new)) < 1e-6
        theta, beta, ll, g, H = th_new, be_new, ll_new, g_new, H_new
        if done or np.max(np.abs(g)) < 1e-10:
            converged = True
            break
    # back to the original feature scale
    shift = float(np.sum(beta * mu / sd))
    theta_o, beta_o = theta + shift, beta / sd
    J = np.zeros((K - 1 + p, K - 1 + p))
    J[:K - 1, :K - 1] = np.eye(K - 1)
    J[:K - 1, K - 1:] = (mu / sd)[None, :]
    J[K - 1:, K - 1:] = np.diag(1.0 / sd)
    try:
        cov = J @ np.linalg.inv(-H) @ J.T
    except np.linalg.LinAlgError:
        cov = J @ np.linalg.pinv(-H) @ J.T
    # gradient on the original scale, for the score-equation check
    grad_o = np.linalg.solve(J.T, g) if np.linalg.matrix_rank(J) == J.shape[0] else g
    return OrderedLogit([float(v) for v in levels], list(features), [float(v) for v in theta_o],
                        [float(v) for v in beta_o], cov, float(ll), it, converged,
                        float(np.max(np.abs(grad_o))), {"n": n})


def decompose(sample: DataFrame, model: OrderedLogit, outcome: str, keep: Sequence[str]) -> DataFrame:
    """Observed = expected + residual, row by row (M11, M12).  The period
    stays a column (H16)."""
    exp = model.expected()
    return sample.select(*keep, F.col(outcome).alias("rating"), exp.alias("expected_rating"),
                         (F.col(outcome) - exp).alias("residual"),
                         *[c for c in sample.columns if c not in set(keep) | {outcome}])


def fixed_model(levels: Sequence[float], thresholds: Sequence[float], slopes: dict[str, float]) -> OrderedLogit:
    """A model at given parameters (scoring without a fit)."""
    return OrderedLogit(list(levels), list(slopes), list(thresholds), list(slopes.values()))
