"""Inference queries: bootstrap, binomial logit, odds ratios, multinomial
(M1-M7, M9, A16, A17, J5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import model as M
from . import oracle as O
from . import panel as P
from .queries import register
from ..functions.bands import BAND_HIGH, BAND_LOW
from ..operators import glm
from ..operators import ordinal as od
from ..operators import resample as rs
from ..session import materialize
from ..sources import tables as tb

N_BOOT = 2000
SEED = 42
MIN_IDS = 5
BUCKETS = 64

W = O.with_ctes


@register("band_sizes", W("near") + """
SELECT period, threshold_band, COUNT(DISTINCT entity_id) AS entities, COUNT(*) AS rows,
       SUM(total_measure) AS total_size
FROM near WHERE threshold_band IN ('3.5-3.9', '4.0-4.5') GROUP BY 1, 2""")
def q_band_sizes(spark, d):
    """Distinct ids, rows and summed size per period and band."""
    n = P.near_threshold(spark, d).filter(F.col("threshold_band").isin(BAND_LOW, BAND_HIGH))
    return n.groupBy(tb.PERIOD, "threshold_band").agg(
        F.count_distinct(tb.ENTITY).alias("entities"), F.count(F.lit(1)).alias("rows"),
        F.sum("total_measure").alias("total_size"))


_MIX = "((xor({x}, {x} >> 32)::UHUGEINT * 15485907386658061715::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT"

BOOT_SQL = W("near").replace("WITH", "WITH RECURSIVE", 1) + f"""
, bdata AS (SELECT * FROM near WHERE threshold_band IN ('3.5-3.9', '4.0-4.5'))
, ids AS (
  SELECT period, threshold_band, entity_id,
         ROW_NUMBER() OVER (PARTITION BY period, threshold_band ORDER BY bk, entity_id) - 1 AS idx,
         COUNT(*) OVER (PARTITION BY period, threshold_band) AS n
  FROM (SELECT DISTINCT period, threshold_band, entity_id,
               ('0x' || substr(md5(concat_ws(':', 'b', entity_id)), 1, 15))::BIGINT % {BUCKETS} AS bk
        FROM bdata WHERE entity_id IS NOT NULL)
)
, ok AS (
  SELECT period FROM (SELECT DISTINCT period, threshold_band, n FROM ids)
  GROUP BY period HAVING COUNT(*) FILTER (WHERE n >= {MIN_IDS}) = 2
)
, per_id AS (
  SELECT period, threshold_band, entity_id, SUM(rate_exposure) AS sx, COUNT(rate_exposure) AS cx,
         SUM(rate_exposure * total_measure) AS swx, SUM(total_measure) AS sw
  FROM bdata GROUP BY 1, 2, 3
)
, sizes AS (SELECT DISTINCT i.period, i.threshold_band, n FROM ids i SEMI JOIN ok USING (period))
, splits AS (  -- the ranges of ids, from all of them to single ones
  SELECT period, threshold_band, 0::BIGINT AS low, n AS high FROM sizes
  UNION ALL
  SELECT period, threshold_band, CASE h WHEN 0 THEN low ELSE (low + high) // 2 END, CASE h WHEN 0 THEN (low + high) // 2 ELSE high END
  FROM splits, range(2) t(h) WHERE high - low > 1
)
, law AS MATERIALIZED (  -- binomial distribution functions of the splits
  SELECT part, whole, c, list(f ORDER BY k) AS f FROM (
    SELECT part, whole, c, k, sum(exp(lgamma(c + 1) - lgamma(k + 1) - lgamma(c - k + 1) + k * ln(part / whole) + (c - k) * ln(1 - part / whole)))
           OVER (PARTITION BY part, whole, c ORDER BY k) AS f
    FROM (SELECT part, whole, c, unnest(range(0, c)) AS k
          FROM (SELECT DISTINCT (low + high) // 2 - low AS part, high - low AS whole FROM splits WHERE high - low > 1),
               (SELECT unnest(range(1, 1 + (SELECT max(n) FROM sizes))) AS c)))
  GROUP BY part, whole, c
)
, counts AS (
  SELECT period, threshold_band, r AS replicate, 0::BIGINT AS low, n AS high, n AS c FROM sizes, range({N_BOOT}) t(r)
  UNION ALL
  SELECT period, threshold_band, replicate, CASE h WHEN 0 THEN low ELSE (low + high) // 2 END, CASE h WHEN 0 THEN (low + high) // 2 ELSE high END,
         CASE h WHEN 0 THEN k ELSE c - k END
  FROM (
    SELECT x.*, coalesce(len(list_filter(law.f, lambda v: v < x.u)), 0) AS k
    FROM (SELECT *, (xor(x2, x2 >> 32) >> 11)::DOUBLE / 9007199254740992.0::DOUBLE AS u
          FROM (SELECT *, {_MIX.format(x='x1')} AS x2 FROM (SELECT *, {_MIX.format(x='x0')} AS x1 FROM (
            SELECT *, ((('0x' || substr(md5(concat_ws(':', '{SEED}', period, threshold_band, low, high)), 1, 15))::UHUGEINT
                        + replicate::UHUGEINT * 11400714819323198485::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT AS x0
            FROM counts WHERE high - low > 1 AND c > 0)))) x
    JOIN law ON law.part = (x.low + x.high) // 2 - x.low AND law.whole = x.high - x.low AND law.c = x.c
  ), range(2) t(h)
)
, s AS (
  SELECT d.period, d.replicate, d.threshold_band, SUM(p.sx * d.c) AS sx, SUM(p.cx * d.c) AS cx, SUM(p.swx * d.c) AS swx,
         SUM(p.sw * d.c) AS sw
  FROM counts d
  JOIN ids i ON i.period = d.period AND i.threshold_band = d.threshold_band AND i.idx = d.low
  JOIN per_id p ON p.period = i.period AND p.threshold_band = i.threshold_band AND p.entity_id = i.entity_id
  WHERE d.high - d.low = 1 GROUP BY 1, 2, 3
)
, boot AS (
  SELECT a.period, CAST(a.replicate AS INTEGER) AS replicate,
         a.sx / a.cx - b.sx / b.cx AS diff_unweighted,
         (CASE WHEN a.sw <> 0 THEN a.swx / a.sw END) - (CASE WHEN b.sw <> 0 THEN b.swx / b.sw END) AS diff_weighted
  FROM s a JOIN s b ON a.period = b.period AND a.replicate = b.replicate
  WHERE a.threshold_band = '3.5-3.9' AND b.threshold_band = '4.0-4.5'
)
"""


def _boot(spark, d):
    return rs.bootstrap_diff(P.near_threshold(spark, d), tb.PERIOD, "threshold_band", tb.ENTITY,
                             "rate_exposure", "total_measure", (BAND_LOW, BAND_HIGH), N_BOOT, SEED, MIN_IDS, BUCKETS)


@register("bootstrap_diff", BOOT_SQL + "SELECT period, replicate, diff_unweighted, diff_weighted FROM boot",
          ["diff_unweighted", "diff_weighted"])
def q_bootstrap_diff(spark, d):
    """2,000 seeded cluster-bootstrap replicates of the band difference (M1)."""
    return _boot(spark, d)


CI_COLS = [f"{c}_{s}" for c in ("diff_unweighted", "diff_weighted") for s in ("mean", "p2_5", "p50", "p97_5")]


@register("bootstrap_ci", BOOT_SQL + """
SELECT period,
  AVG(diff_unweighted) AS diff_unweighted_mean, quantile_cont(diff_unweighted, 0.025) AS diff_unweighted_p2_5,
  quantile_cont(diff_unweighted, 0.5) AS diff_unweighted_p50, quantile_cont(diff_unweighted, 0.975) AS diff_unweighted_p97_5,
  AVG(diff_weighted) AS diff_weighted_mean, quantile_cont(diff_weighted, 0.025) AS diff_weighted_p2_5,
  quantile_cont(diff_weighted, 0.5) AS diff_weighted_p50, quantile_cont(diff_weighted, 0.975) AS diff_weighted_p97_5
FROM boot GROUP BY period""", CI_COLS)
def q_bootstrap_ci(spark, d):
    """Mean and 2.5 / 50 / 97.5 percentiles of the replicates (M2)."""
    return rs.bootstrap_ci(_boot(spark, d), tb.PERIOD)


# ------------------------------------------------------------------ logit

def near_structural(spark, d):
    """Near-threshold rows in the two bands with both exposures."""
    counts = P.staged_counts(spark, d)  # both exposures and the ratings start from one scan of the facts
    n = P.near_threshold(spark, d, counts).filter(F.col("threshold_band").isin(BAND_LOW, BAND_HIGH))
    r = P.static_exposure(spark, d, counts).select(*P.KEYS, "static_exposure")
    return n.join(r, P.KEYS, "left")


@register("near_threshold_structural", W("near", "static_exposure") + """
SELECT n.entity_id, n.period, n.rating, n.threshold_band, n.above_threshold, n.total_measure, n.rate_exposure,
       r.static_exposure
FROM near n LEFT JOIN static_exposure r ON r.entity_id = n.entity_id AND r.period = n.period
WHERE n.threshold_band IN ('3.5-3.9', '4.0-4.5')""", ["rating", "rate_exposure", "static_exposure"])
def q_near_structural(spark, d):
    return near_structural(spark, d).select(*P.KEYS, "rating", "threshold_band", "above_threshold",
                                            "total_measure", "rate_exposure", "static_exposure")


def _logit_table(data, features, weighted):
    fit = glm.fit_logit(data, "above_threshold", features, [tb.PERIOD], weight="total_measure" if weighted else None)
    return fit.table(data.sparkSession)


def _logit_ctes(tag: str, features: list[str], weight: str) -> list[str]:
    """CTEs up to ``t_<tag>``: estimates and HC1 errors of one or two exposures
    beside an intercept for each period, by Newton steps.

    With an intercept a period the information matrix is an arrow: the slopes'
    step solves its Schur complement (s11, s12, s22), the intercepts follow.  A
    row's influence on a term is its column of the inverse; the robust variance
    sums the squared influences times the squared error."""
    two = len(features) == 2
    x = [*features, "0.0"][:2]
    s22 = "sum(h22) OVER w - sum(c2 * c2 / h) OVER w" if two else "1.0"

    def sums(it):
        return f"""
    SELECT {it} r.period, any_value(a) AS a, any_value(b1) AS b1, any_value(b2) AS b2, sum(f * (y - p)) AS g, sum(q) AS h, sum(q * x1) AS c1,
           sum(q * x2) AS c2, sum(f * (y - p) * x1) AS g1, sum(f * (y - p) * x2) AS g2, sum(q * x1 * x1) AS h11,
           sum(q * x1 * x2) AS h12, sum(q * x2 * x2) AS h22
    FROM (SELECT *, f * p * (1 - p) AS q FROM (
            SELECT r.*, {it} a, b1, b2, 1 / (1 + exp(-(a + b1 * x1 + b2 * x2))) AS p FROM rows_{tag} r JOIN {{state}} s ON s.period = r.period)) r
    GROUP BY {it} r.period"""

    schur = f"""sum(h11) OVER w - sum(c1 * c1 / h) OVER w AS s11, sum(h12) OVER w - sum(c1 * c2 / h) OVER w AS s12, {s22} AS s22,
           sum(g1) OVER w - sum(c1 * g / h) OVER w AS r1, sum(g2) OVER w - sum(c2 * g / h) OVER w AS r2"""
    return [f"""
rows_{tag} AS MATERIALIZED (
  SELECT n.period, above_threshold::DOUBLE AS y, ({weight})::DOUBLE AS f, {x[0]} AS x1, {x[1]} AS x2
  FROM near n LEFT JOIN static_exposure e USING (entity_id, period) WHERE {' AND '.join(f'{c} IS NOT NULL' for c in features)})""", f"""
newton_{tag} AS (
  SELECT 0 AS it, period, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM (SELECT DISTINCT period FROM rows_{tag})
  UNION ALL
  SELECT it + 1, period, a + (g - c1 * d1 - c2 * d2) / h, b1 + d1, b2 + d2 FROM (
    SELECT *, (s22 * r1 - s12 * r2) / (s11 * s22 - s12 * s12) AS d1, (s11 * r2 - s12 * r1) / (s11 * s22 - s12 * s12) AS d2 FROM (
      SELECT *, {schur}
      FROM ({sums('it,').format(state=f'newton_{tag}')})
      WINDOW w AS ()))
  WHERE it < 30)""", f"""
at_{tag} AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY period) AS place, {schur} FROM ({sums('').format(state=f'(SELECT * FROM newton_{tag} WHERE it = 30)')}) WINDOW w AS ()),
score_{tag} AS (
  SELECT r.*, v1, v2, f * (y - p) * (y - p) AS m FROM (
    SELECT r.period, r.y, r.f, 1 / (1 + exp(-(a + b1 * x1 + b2 * x2))) AS p,
           (s22 * (x1 - c1 / h) - s12 * (x2 - c2 / h)) / (s11 * s22 - s12 * s12) AS v1,
           (s11 * (x2 - c2 / h) - s12 * (x1 - c1 / h)) / (s11 * s22 - s12 * s12) AS v2
    FROM rows_{tag} r JOIN at_{tag} s ON s.period = r.period) r),
cut_{tag} AS (
  SELECT q.place, q.period, q.a, s.m, if(s.period = q.period, 1 / q.h, 0) - q.c1 / q.h * s.v1 - q.c2 / q.h * s.v2 AS v,
         if(s.period = o.period, 1 / o.h, 0) - o.c1 / o.h * s.v1 - o.c2 / o.h * s.v2 AS v_base, o.a AS a_base
  FROM score_{tag} s, at_{tag} q, (SELECT * FROM at_{tag} WHERE place = 1) o),
size_{tag} AS (SELECT sum(f) / (sum(f) - (SELECT count(*) + {len(features)} FROM at_{tag})) AS k FROM rows_{tag}),
t_{tag} AS (
  SELECT term, b AS estimate, sqrt(k * v) AS std_error FROM size_{tag}, (
    SELECT '{features[0]}' AS term, (SELECT any_value(b1) FROM at_{tag}) AS b, sum(m * v1 * v1) AS v FROM score_{tag}
    {f"UNION ALL SELECT '{features[1]}', (SELECT any_value(b2) FROM at_{tag}), sum(m * v2 * v2) FROM score_{tag}" if two else ""}
    UNION ALL
    SELECT if(place = 1, 'Intercept', 'C(period)[T.' || period || ']'), any_value(if(place = 1, a, a - a_base)),
           sum(m * if(place = 1, v * v, (v - v_base) * (v - v_base))) FROM cut_{tag} GROUP BY place, period))"""]


def _logit_sql(models: list[tuple[str, list[str], str]], select: str) -> str:
    parts = [p for m in models for p in _logit_ctes(*m)]
    return W("near", "static_exposure", extra=parts).replace("WITH", "WITH RECURSIVE", 1) + select


LOGIT_COLS = ["estimate", "std_error", "z_value", "odds_ratio", "ci_low", "ci_high"]
_LOGIT_OUT = """
SELECT term, estimate, std_error, estimate / std_error AS z_value, exp(estimate) AS odds_ratio, exp(estimate - 1.96::DOUBLE * std_error) AS ci_low,
       exp(estimate + 1.96::DOUBLE * std_error) AS ci_high, true AS converged FROM t_m"""
RATE, BOTH, SIZE = ["rate_exposure"], ["rate_exposure", "static_exposure"], "n.total_measure"


@register("logit_coef", _logit_sql([("m", RATE, "1.0")], _LOGIT_OUT), LOGIT_COLS)
def q_logit_coef(spark, d):
    """above ~ rate_exposure + C(period), HC1 (M3, M6, M7)."""
    return _logit_table(near_structural(spark, d), RATE, False).drop("iterations", "max_score")


@register("logit_weighted", _logit_sql([("m", RATE, SIZE)], _LOGIT_OUT), LOGIT_COLS)
def q_logit_weighted(spark, d):
    """Same with size as frequency weight (M4)."""
    return _logit_table(near_structural(spark, d), RATE, True).drop("iterations", "max_score")


@register("logit_two_exposures", _logit_sql([("m", BOTH, "1.0")], _LOGIT_OUT), LOGIT_COLS)
def q_logit_two(spark, d):
    """above ~ rate_exposure + static_exposure + C(period), HC1 (M5)."""
    return _logit_table(near_structural(spark, d), BOTH, False).drop("iterations", "max_score")


@register("odds_ratios", _logit_sql([("m", BOTH, "1.0"), ("w", BOTH, SIZE)], """
SELECT model, term, exp(estimate) AS odds_ratio, exp(estimate - 1.96::DOUBLE * std_error) AS ci_low, exp(estimate + 1.96::DOUBLE * std_error) AS ci_high
FROM (SELECT 'unweighted' AS model, * FROM t_m UNION ALL SELECT 'weighted', * FROM t_w) WHERE term IN ('rate_exposure', 'static_exposure')"""),
          ["odds_ratio", "ci_low", "ci_high"])
def q_odds_ratios(spark, d):
    """Odds ratios with 95% intervals for the exposure terms of the
    unweighted and weighted two-exposure models (M7), from one staged sample."""
    data = materialize(near_structural(spark, d), "near_structural")
    out = None
    for name, weighted in (("unweighted", False), ("weighted", True)):
        t = (_logit_table(data, BOTH, weighted).filter(F.col("term").isin(*BOTH))
             .select(F.lit(name).alias("model"), "term", "odds_ratio", "ci_low", "ci_high"))
        out = t if out is None else out.unionByName(t)
    return out


@register("logit_states", W("near", "static_exposure") + """
SELECT m.model, true AS converged, true AS score_vanishes, count(*) AS rows, sum(if(m.model = 'weighted', n.total_measure, 1)) AS weights
FROM near n LEFT JOIN static_exposure e USING (entity_id, period), (SELECT unnest(['unweighted', 'weighted']) AS model) m
WHERE rate_exposure IS NOT NULL AND static_exposure IS NOT NULL GROUP BY m.model""", ["weights"])
def q_logit_states(spark, d):
    """State of the two-exposure fits: converged, largest score against the
    weights, rows and weights used (M3-M5)."""
    data = materialize(near_structural(spark, d), "near_structural")
    rows = []
    for name, weight in (("unweighted", None), ("weighted", "total_measure")):
        fit = glm.fit_logit(data, "above_threshold", BOTH, [tb.PERIOD], weight=weight)
        rows.append((name, fit.converged, fit.max_score <= 1e-8 * fit.sum_weights, fit.n_rows, fit.sum_weights))
    return spark.createDataFrame(rows, "model string, converged boolean, score_vanishes boolean, rows bigint, weights double")


@register("multinomial_coef")
def q_multinomial(spark, d):
    """Multinomial logit of the rating level on the model features (M9)."""
    s, levels, feats = M.sample(spark, d)
    return glm.fit_multinomial(s, "level_index", feats, len(levels)).table(spark)


@register("multinomial_score", O.with_ctes("model_frame") + f"""
, sample AS (
  SELECT *, ln(greatest(coalesce(total_size, 1.0), 1.0)) AS log_size, dense_rank() OVER (ORDER BY rating) - 1 AS k FROM model_frame
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in M.CORE)}),
terms AS (
  SELECT k, unnest(['const', {', '.join(repr(c) for c in M.FEATURES)}]) AS term, unnest([1.0, {', '.join(M.FEATURES)}]) AS x FROM sample
  UNION ALL
  SELECT s.k, 'period_' || p.period, (s.period = p.period)::INTEGER
  FROM sample s, (SELECT DISTINCT period FROM sample WHERE period > (SELECT min(period) FROM sample)) p)
SELECT c.k::INTEGER AS class, t.term, round(sum(t.x) FILTER (t.k = c.k) / sum(t.x) + 1e-9, 5) AS share
FROM terms t, (SELECT DISTINCT k FROM sample WHERE k > 0) c GROUP BY ALL""")
def q_multinomial_score(spark, d):
    """At the optimum, or on the way to none, the fitted sums of every class and
    term equal the observed ones: each as a share of the term's sum (M9)."""
    s, levels, feats = M.sample(spark, d)
    fit = glm.fit_multinomial(s, "level_index", feats, len(levels))
    xs = [F.lit(1.0), *[F.col(f) for f in feats]]
    eta = [F.exp(sum((F.lit(float(b)) * x for b, x in zip(row, xs)), F.lit(0.0))) for row in fit.coef]
    rows = s.select(*[x.alias(f"x{i}") for i, x in enumerate(xs)], *[e.alias(f"e{k}") for k, e in enumerate(eta)])
    whole = 1 + sum((F.col(f"e{k}") for k in range(len(eta))), F.lit(0.0))
    rows = rows.select("*", *[(F.col(f"e{k}") / whole).alias(f"p{k}") for k in range(len(eta))])
    sums = rows.agg(*[F.sum(f"x{i}").alias(f"s{i}") for i in range(len(xs))],
                    *[F.sum(F.col(f"p{k}") * F.col(f"x{i}")).alias(f"s{i}_{k}") for k in range(len(eta)) for i in range(len(xs))])
    told = F.array(*[F.struct(F.lit(k + 1).alias("class"), F.lit(t).alias("term"),
                              F.round(F.col(f"s{i}_{k}") / F.col(f"s{i}") + O.TIE, 5).alias("share"))
                     for k in range(len(eta)) for i, t in enumerate(fit.terms)])
    return sums.select(F.inline(told))


# ------------------------------------------------------------------ fits held against SQL
#
# At the optimum of a logit X'f(y - p) = 0: the fitted sums f p x of every term
# equal the observed sums f y x, which SQL has without a fit.

def _score_table(spark, d, features, weighted):
    data = materialize(near_structural(spark, d), "near_structural")
    weight = "total_measure" if weighted else None
    fit = glm.fit_logit(data, "above_threshold", features, [tb.PERIOD], weight=weight)
    X, terms = glm.design(data, features, [tb.PERIOD])
    eta = sum((F.lit(float(b)) * F.col(f"_x{i}") for i, b in enumerate(fit.coef)), F.lit(0.0))
    f = F.col(weight) if weighted else F.lit(1.0)
    p = f / (1 + F.exp(-eta))
    sums = X.agg(F.array(*[F.struct(F.lit(t).alias("term"), F.sum(p * F.col(f"_x{i}")).alias("total"))
                           for i, t in enumerate(terms)]).alias("s"))
    # relative to the sum of weights, so the six places compared are of the score
    total = X.agg(F.sum(f)).scalar()
    return sums.select(F.inline("s")).withColumn("share", F.round(F.col("total") / total + O.TIE, 5)).select("term", "share")


def _score_sql(features, weight):
    terms = [("Intercept", "1")] + [(f, f) for f in features]
    parts = [f"SELECT '{t}' AS term, sum(f * above_threshold * {x}) / sum(f) AS share FROM rows" for t, x in terms]
    return W("near", "static_exposure") + f"""
, rows AS (
  SELECT n.*, s.static_exposure, {weight} AS f FROM near n LEFT JOIN static_exposure s USING (entity_id, period)
  WHERE {' AND '.join(f'{x} IS NOT NULL' for x in features)}
), levels AS (SELECT DISTINCT period FROM rows WHERE period > (SELECT min(period) FROM rows))
SELECT term, round(share + 1e-9, 5) AS share FROM (
  {' UNION ALL '.join(parts)}
  UNION ALL
  SELECT 'C(period)[T.' || l.period || ']', (SELECT sum(f * above_threshold) FROM rows r WHERE r.period = l.period)
         / (SELECT sum(f) FROM rows) FROM levels l)"""


for _name, _features, _weighted in (("logit_score", ["rate_exposure"], False), ("logit_weighted_score", ["rate_exposure"], True),
                                    ("logit_two_exposures_score", ["rate_exposure", "static_exposure"], False)):
    register(_name, _score_sql(_features, "n.total_measure" if _weighted else "1.0"))(
        lambda spark, d, fs=_features, w=_weighted: _score_table(spark, d, fs, w))


@register("logit_period_only", W("near") + """
, g AS (SELECT period, count(*) AS n, avg(above_threshold) AS p FROM near GROUP BY period),
b AS (SELECT * FROM g ORDER BY period LIMIT 1), c AS (SELECT sum(n) / (sum(n) - count(*)) AS k FROM g)
SELECT CASE WHEN g.period = b.period THEN 'Intercept' ELSE 'C(period)[T.' || g.period || ']' END AS term,
       ln(g.p / (1 - g.p)) - CASE WHEN g.period = b.period THEN 0 ELSE ln(b.p / (1 - b.p)) END AS estimate,
       sqrt(c.k * (1 / (g.n * g.p * (1 - g.p)) + CASE WHEN g.period = b.period THEN 0 ELSE 1 / (b.n * b.p * (1 - b.p)) END)) AS std_error,
       exp(ln(g.p / (1 - g.p)) - CASE WHEN g.period = b.period THEN 0 ELSE ln(b.p / (1 - b.p)) END) AS odds_ratio
FROM g, b, c""", ["estimate", "std_error", "odds_ratio"])
def q_logit_period_only(spark, d):
    """above ~ C(period): estimates, HC1 errors and odds ratios have closed
    forms in the counts of each period (M3, M6, M7)."""
    fit = glm.fit_logit(P.near_threshold(spark, d), "above_threshold", [], [tb.PERIOD])
    return fit.table(spark).select("term", "estimate", "std_error", "odds_ratio")
