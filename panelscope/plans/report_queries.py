"""Model-sample, scoring and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import model as M
from . import oracle as O
from .queries import register
from ..functions.bands import period_label
from ..operators import bins as bn
from ..operators import ordinal as od
from ..operators import report as rp
from ..operators.order import with_position
from ..operators.quantiles import approximate_quantiles, merge_sketches, quantile_sketches
from ..session import materialize
from ..sources import tables as tb

CORE = M.CORE
OUT = M.OUT_COLS
OUT_DOUBLES = ["rating", "expected_rating", "residual", *CORE, "total_size", "log_size"]

# ------------------------------------------------------------------ oracle CTEs
_core_nn = " AND ".join(f"{c} IS NOT NULL" for c in CORE)
_eta = " + ".join([f"{v!r} * {k}" for k, v in M.FIXED_SLOPES.items()])
_eff = "CASE " + " ".join(f"WHEN period = {p} THEN {v!r}" for p, v in M.FIXED_PERIOD_EFFECTS.items()) + " ELSE 0.0 END"
_cum = ", ".join(f"1.0 / (1.0 + exp(-({t!r} - eta))) AS f{j}" for j, t in enumerate(M.FIXED_THRESHOLDS))
_K = len(M.FIXED_LEVELS)
_probs = ["f0"] + [f"(f{j} - f{j - 1})" for j in range(1, _K - 1)] + [f"(1.0 - f{_K - 2})"]
_exp = " + ".join(f"{lv!r} * {p}" for lv, p in zip(M.FIXED_LEVELS, _probs))

SAMPLE_CTE = f"""
sample AS (
  SELECT entity_id, period, rating, {", ".join(CORE)}, ts AS total_size, ln(ts) AS log_size
  FROM (SELECT *, GREATEST(COALESCE(total_size, 1.0), 1.0) AS ts FROM model_frame
        WHERE rating IS NOT NULL AND {_core_nn})
)"""

SCORED_CTE = f"""
scored AS (
  SELECT *, {_exp} AS expected_rating,
         {", ".join(f"{p} AS p{k}" for k, p in enumerate(_probs))}
  FROM (SELECT *, {_cum} FROM (SELECT *, ({_eta}) + ({_eff}) AS eta FROM sample))
)"""

DECOMP_CTE = f"""
decomp AS (
  SELECT entity_id, period, rating, expected_rating, rating - expected_rating AS residual,
         {", ".join(CORE)}, total_size, log_size
  FROM scored
)"""


def W(*extra: str) -> str:
    return O.with_ctes("model_frame", extra=[SAMPLE_CTE, SCORED_CTE, DECOMP_CTE, *extra])


COLS = ", ".join(OUT)

# ------------------------------------------------------------------ sample, levels


@register("model_sample", W() + """
SELECT entity_id, period, rating, CAST(DENSE_RANK() OVER (ORDER BY rating) - 1 AS INTEGER) AS level_index,
       total_size, log_size FROM sample""", ["rating", "total_size", "log_size"])
def q_model_sample(spark, d):
    s, _, _ = od.model_sample(M.P.model_frame(spark, d), "rating", CORE, "total_size", tb.PERIOD)
    return s.select(tb.ENTITY, tb.PERIOD, "rating", "level_index", "total_size", "log_size")


@register("levels_index", W() + """
SELECT rating, CAST(DENSE_RANK() OVER (ORDER BY rating) - 1 AS INTEGER) AS level_index
FROM (SELECT DISTINCT rating FROM sample)""", ["rating"])
def q_levels_index(spark, d):
    s, _, _ = od.model_sample(M.P.model_frame(spark, d), "rating", CORE, "total_size", tb.PERIOD)
    return s.select("rating", "level_index").distinct()


@register("period_dummies", W() + """
SELECT period, CAST(DENSE_RANK() OVER (ORDER BY period) - 1 AS INTEGER) AS dummy_index,
       CAST(CASE WHEN period = (SELECT MIN(period) FROM sample) THEN 1 ELSE 0 END AS INTEGER) AS is_baseline,
       n FROM (SELECT period, COUNT(*) AS n FROM sample GROUP BY period)""")
def q_period_dummies(spark, d):
    """Dummy coding of the period (P30): index of each level, the lowest
    level is the dropped baseline; the row count per level."""
    s, _, periods = od.model_sample(M.P.model_frame(spark, d), "rating", CORE, "total_size", tb.PERIOD)
    s, names = od.period_dummies(s, tb.PERIOD, periods)
    idx = F.array_position(F.array(*[F.lit(p) for p in periods]), F.col(tb.PERIOD)) - 1
    base = F.when(sum((F.col(n) for n in names), F.lit(0.0)) == 0, 1).otherwise(0)
    return (s.groupBy(tb.PERIOD).agg(F.count(F.lit(1)).alias("n"), F.max(base).cast("int").alias("is_baseline"))
            .select(tb.PERIOD, idx.cast("int").alias("dummy_index"), "is_baseline", "n"))


# ------------------------------------------------------------------ scoring

def _decomp(spark, d, staged=False):
    return M.decomposition_fixed(spark, d, staged)


@register("decomposition_fixed", W() + f"SELECT {COLS} FROM decomp", OUT_DOUBLES)
def q_decomposition_fixed(spark, d):
    return _decomp(spark, d)


@register("expected_level", W() + "SELECT entity_id, period, rating, expected_rating FROM decomp",
          ["rating", "expected_rating"])
def q_expected_level(spark, d):
    return _decomp(spark, d).select(tb.ENTITY, tb.PERIOD, "rating", "expected_rating")


PCOLS = [f"p{k}" for k in range(_K)]


@register("class_probabilities", W() + f"SELECT entity_id, period, {', '.join(PCOLS)} FROM scored", PCOLS)
def q_class_probabilities(spark, d):
    s = M.fixed_sample(spark, d)
    probs = M.fixed_model().probabilities()
    return s.select(tb.ENTITY, tb.PERIOD, probs.alias("_p")).select(
        tb.ENTITY, tb.PERIOD, *[F.col("_p")[k].alias(c) for k, c in enumerate(PCOLS)])


# ------------------------------------------------------------------ reports

@register("full_export", W() + f"""
SELECT row_number() OVER (ORDER BY entity_id, period, rating) AS position, {COLS} FROM decomp ORDER BY position""", OUT_DOUBLES)
def q_full_export(spark, d):
    """All rows with their place in the export's order."""
    return with_position(_decomp(spark, d), tb.ENTITY, tb.PERIOD, "rating").select("position", *OUT).orderBy("position")


@register("near_slices", W() + f"""
SELECT '3.0-3.9' AS slice, {COLS} FROM decomp WHERE rating BETWEEN 3.0 AND 3.9
UNION ALL
SELECT '3.5-3.9' AS slice, {COLS} FROM decomp WHERE rating BETWEEN 3.5 AND 3.9""", OUT_DOUBLES)
def q_near_slices(spark, d):
    return rp.near_slices(_decomp(spark, d, True)).select("slice", *OUT)


RANK_COLS = [tb.ENTITY, "rating", "expected_rating", "residual", "rate_exposure", "static_exposure",
             "score_exposure", "log_size", "total_size", tb.PERIOD]
RANK_DOUBLES = [c for c in RANK_COLS if c not in (tb.ENTITY, tb.PERIOD)]


@register("opportunity_top50", W() + f"""
SELECT {", ".join(RANK_COLS)} FROM decomp WHERE rating >= 3.5 AND rating <= 3.9
ORDER BY period, residual, entity_id LIMIT 50""", RANK_DOUBLES)
def q_opportunity_top50(spark, d):
    """Most negative residuals among 3.5-3.9 rated rows, period first, 50
    overall (O3): the limit is the report."""
    return rp.ranked(_decomp(spark, d), [tb.PERIOD, "residual", tb.ENTITY], 50, cols=RANK_COLS)


@register("opportunity_by_period", W() + f"""
SELECT {", ".join(RANK_COLS)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY period ORDER BY residual, entity_id) AS rn
  FROM decomp WHERE rating >= 3.5 AND rating <= 3.9) WHERE rn <= 10""", RANK_DOUBLES)
def q_opportunity_by_period(spark, d):
    """Per-period variant of the ranked list (H14 option): 10 per period."""
    return rp.ranked(_decomp(spark, d), ["residual", tb.ENTITY], 10, cols=RANK_COLS, per_group=tb.PERIOD)


DISPLAY_FMT = {"rating": "%.1f", "expected_rating": "%.2f", "residual": "%.2f", "score_exposure": "%.2f",
               "rate_exposure": "%.2f", "log_size": "%.2f"}
#: Labels of the periods in the display; others read Unknown.
PERIOD_LABELS = {1997: "FY 1997", 1998: "FY 1998"}


@register("opportunity_display", W() + """
SELECT entity_id, CASE WHEN period IN (1997, 1998) THEN 'FY ' || period ELSE 'Unknown' END AS period_label,
       """ + ", ".join(f"printf('{f}', {c}) AS {c}" for c, f in DISPLAY_FMT.items()) + """
FROM (SELECT * FROM decomp WHERE rating >= 3.5 AND rating <= 3.9 ORDER BY period, residual, entity_id LIMIT 15)""")
def q_opportunity_display(spark, d):
    """Top-15 display slice: six formatted numbers and the period's label."""
    top = rp.ranked(_decomp(spark, d), [tb.PERIOD, "residual", tb.ENTITY], 50,
                    cols=[tb.ENTITY, tb.PERIOD, *DISPLAY_FMT])
    shown = rp.display_slice(top, [tb.PERIOD, "residual", tb.ENTITY], 15)
    return shown.select(tb.ENTITY, period_label(tb.PERIOD, PERIOD_LABELS).alias("period_label"),
                        *[F.format_string(f, F.col(c)).alias(c) for c, f in DISPLAY_FMT.items()])


BUCKET_MEANS = {"mean_rating": "rating", "mean_expected": "expected_rating", "mean_residual": "residual",
                "mean_score": "score_exposure", "mean_rate": "rate_exposure", "mean_log_size": "log_size"}


@register("bucket_summary", W() + """
SELECT period, bucket, COUNT(*) AS n, AVG(rating) AS mean_rating, AVG(expected_rating) AS mean_expected,
       AVG(residual) AS mean_residual, AVG(score_exposure) AS mean_score, AVG(rate_exposure) AS mean_rate,
       AVG(log_size) AS mean_log_size
FROM (SELECT *, CASE WHEN residual >= 0.25 THEN 'Operational overperformance (above structural expectation)'
                     WHEN residual <= -0.25 THEN 'Operational underperformance (execution opportunity)'
                     ELSE 'Near expectation (within ±0.25)' END AS bucket FROM decomp)
GROUP BY 1, 2""", list(BUCKET_MEANS))
def q_bucket_summary(spark, d):
    return rp.bucket_summary(_decomp(spark, d), tb.PERIOD, means=BUCKET_MEANS)


def _decile_sql(col: str, label: str) -> str:
    return W() + f"""
, edges AS (
  SELECT list_distinct(quantile_cont({col}, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS e
  FROM decomp WHERE {col} IS NOT NULL
), binned AS (
  SELECT d.*, CAST(GREATEST(1, len(list_filter(edges.e, lambda x: x < d.{col}))) AS INTEGER) AS decile
  FROM decomp d, edges WHERE d.{col} IS NOT NULL
)
SELECT '{label}' AS feature, period, decile, COUNT(rating) AS n, AVG({col}) AS feature_mean,
       AVG(rating) AS rating_mean, AVG(expected_rating) AS expected_mean, AVG(residual) AS residual_mean
FROM binned GROUP BY period, decile"""


DECILE_DOUBLES = ["feature_mean", "rating_mean", "expected_mean", "residual_mean"]
DECILES = {
    "decile_effect_rate": ("rate_exposure", "Rate exposure"),
    "decile_effect_score": ("score_exposure", "Score exposure"),
    "decile_effect_size": ("log_size", "Scale (log size)"),
    "decile_effect_units": ("n_units", "Unit count"),
}


def _make_decile(col: str, label: str):
    def q(spark, d):
        return bn.decile_table(_decomp(spark, d, True).select(tb.PERIOD, col, "rating", "expected_rating", "residual"), col, label, tb.PERIOD)
    return q


for _name, (_col, _label) in DECILES.items():
    register(_name, _decile_sql(_col, _label), DECILE_DOUBLES)(_make_decile(_col, _label))


@register("gradient_series", _decile_sql("log_size", "x").replace(
    "SELECT 'x' AS feature, period, decile, COUNT(rating) AS n, AVG(log_size) AS feature_mean,\n"
    "       AVG(rating) AS rating_mean, AVG(expected_rating) AS expected_mean, AVG(residual) AS residual_mean",
    "SELECT period, decile, AVG(expected_rating) AS expected_mean"), ["expected_mean"])
def q_gradient_series(spark, d):
    """Expected mean by size decile per period, sorted."""
    return bn.gradient_series(bn.decile_table(_decomp(spark, d, True), "log_size", "x", tb.PERIOD), tb.PERIOD)


SNAP_COLS = ["rating", "expected_rating", "residual", *CORE, "log_size", "total_size", tb.PERIOD]


def _summary_sql() -> str:
    stats = [("count", "CAST(COUNT({c}) AS DOUBLE)"), ("mean", "AVG({c})"), ("std", "STDDEV_SAMP({c})"),
             ("min", "MIN({c})"), ("25%", "quantile_cont({c}, 0.25)"), ("50%", "quantile_cont({c}, 0.5)"),
             ("75%", "quantile_cont({c}, 0.75)"), ("max", "MAX({c})")]
    parts = []
    for name, f in stats:
        cols = ", ".join(f"CAST({f.format(c=c)} AS DOUBLE) AS {c}" for c in SNAP_COLS)
        parts.append(f"SELECT '{name}' AS stat, {cols} FROM decomp")
    return W() + "\nUNION ALL\n".join(parts)


@register("summary_stats", _summary_sql(), SNAP_COLS)
def q_summary_stats(spark, d):
    return rp.summary_stats(_decomp(spark, d, True), SNAP_COLS)


@register("residual_box", W() + """
, banded AS (
  SELECT *, CASE WHEN rating >= 3.0 AND rating < 3.5 THEN '3.0-3.4'
                 WHEN rating >= 3.5 AND rating <= 3.9 THEN '3.5-3.9'
                 WHEN rating >= 4.0 THEN '4.0+' END AS report_band FROM decomp WHERE rating >= 3.0
), q AS (
  SELECT report_band, COUNT(residual) AS n, quantile_cont(residual, 0.25) AS q1,
         quantile_cont(residual, 0.5) AS median, quantile_cont(residual, 0.75) AS q3
  FROM banded GROUP BY 1
)
SELECT q.report_band, q.n, q.q1, q.median, q.q3,
       MIN(CASE WHEN b.residual >= q.q1 - 1.5 * (q.q3 - q.q1) THEN b.residual END) AS whisker_low,
       MAX(CASE WHEN b.residual <= q.q3 + 1.5 * (q.q3 - q.q1) THEN b.residual END) AS whisker_high,
       COUNT(*) FILTER (WHERE b.residual < q.q1 - 1.5 * (q.q3 - q.q1) OR b.residual > q.q3 + 1.5 * (q.q3 - q.q1)) AS outliers
FROM q JOIN banded b ON b.report_band = q.report_band
GROUP BY q.report_band, q.n, q.q1, q.median, q.q3""", ["q1", "median", "q3", "whisker_low", "whisker_high"])
def q_residual_box(spark, d):
    return rp.residual_box(_decomp(spark, d, True))


@register("scatter_frame", W() + """
SELECT entity_id, period, expected_rating, rating,
       CAST(CASE WHEN rating BETWEEN 3.0 AND 3.9 THEN 1 ELSE 0 END AS INTEGER) AS near_flag,
       (SELECT LEAST(MIN(expected_rating), MIN(rating)) FROM decomp) AS line_min,
       (SELECT GREATEST(MAX(expected_rating), MAX(rating)) FROM decomp) AS line_max
FROM decomp""", ["expected_rating", "rating", "line_min", "line_max"])
def q_scatter_frame(spark, d):
    return rp.scatter_frame(_decomp(spark, d, True))


# ------------------------------------------------------------------ fitted model (rows-only checks)

@register("ordered_logit")
def q_ordered_logit(spark, d):
    """Fitted thresholds and slopes with standard errors (M8)."""
    m = M.fit(spark, d)
    return spark.createDataFrame(m.params_rows(), "param string, kind string, estimate double, std_error double")


@register("decomposition")
def q_decomposition(spark, d):
    """Observed = expected + residual at the fitted parameters."""
    return M.decomposition(spark, d)


# ------------------------------------------------------------------ reports at the fitted model (rows-only)

@register("bucket_summary_fitted")
def q_bucket_summary_fitted(spark, d):
    """Bucket summary over the fitted decomposition (M16 after M8)."""
    return rp.bucket_summary(M.decomposition(spark, d), tb.PERIOD, means=BUCKET_MEANS)


@register("decile_effect_score_fitted")
def q_decile_score_fitted(spark, d):
    """Score-exposure decile table over the fitted decomposition (M15 after M8)."""
    return bn.decile_table(M.decomposition(spark, d), "score_exposure", "Score exposure", tb.PERIOD)


@register("opportunity_top50_fitted")
def q_opportunity_fitted(spark, d):
    """Ranked 3.5-3.9 list over the fitted decomposition (O3 after M8)."""
    return rp.ranked(M.decomposition(spark, d), [tb.PERIOD, "residual", tb.ENTITY], 50, cols=RANK_COLS)


@register("ordered_thresholds_only", W() + """
, c AS (SELECT rating, count(*) AS n FROM sample GROUP BY rating),
f AS (SELECT rating, lead(rating) OVER o AS upper, sum(n) OVER o * 1.0 / sum(n) OVER () AS share FROM c
      WINDOW o AS (ORDER BY rating))
SELECT rating AS lower_level, upper AS upper_level, ln(share / (1 - share)) AS threshold FROM f WHERE upper IS NOT NULL""",
          ["lower_level", "upper_level", "threshold"])
def q_ordered_thresholds_only(spark, d):
    """Ordered logit without slopes: its thresholds are the logits of the
    cumulative shares (M8)."""
    s, levels, _ = od.model_sample(M.P.model_frame(spark, d), "rating", CORE, "total_size", tb.PERIOD)
    m = od.fit_ordered_logit(s, "level_index", [], levels)
    return spark.createDataFrame([(float(a), float(b), float(t)) for a, b, t in zip(levels[:-1], levels[1:], m.thresholds)],
                                 "lower_level double, upper_level double, threshold double")


@register("sketch_rank_error", W() + """
SELECT period, p, true AS within FROM (SELECT DISTINCT period FROM decomp UNION ALL SELECT NULL), (SELECT unnest(range(1, 10)) / 10.0::DOUBLE AS p)""", ["p"])
def q_sketch_rank_error(spark, d):
    """Deciles of the residual from stored sketches, one a period and merged
    over all (period null): each is the value at a rank within the stated
    error of its share (A18, W4)."""
    rows = _decomp(spark, d, True).select(tb.PERIOD, "residual")
    sketches = materialize(quantile_sketches(rows, "residual", [tb.PERIOD]), "sketches")
    probs = [i / 10 for i in range(1, 10)]
    every = merge_sketches(sketches, []).withColumn(tb.PERIOD, F.lit(None).cast("int"))
    edges = approximate_quantiles(sketches.unionByName(every), probs, [tb.PERIOD]).withColumnRenamed(tb.PERIOD, "edge_period")
    both = rows.unionByName(rows.withColumn(tb.PERIOD, F.lit(None).cast("int")))
    ranks = both.join(edges, F.col(tb.PERIOD).eqNullSafe(F.col("edge_period"))).groupBy(tb.PERIOD, "p", "rank_error").agg(
        F.avg((F.col("residual") < F.col("q")).cast("double")).alias("below"), F.avg((F.col("residual") <= F.col("q")).cast("double")).alias("up_to"))
    p, e = F.col("p"), F.col("rank_error")
    return ranks.select(tb.PERIOD, "p", ((F.col("below") <= p + e) & (F.col("up_to") >= p - e)).alias("within"))


@register("fit_states")
def q_fit_states(spark, d):
    """State of the ordered fit: converged, iterations, largest score, rows
    used and rows the sample rule left out (M8, M14)."""
    frame = materialize(M.P.model_frame(spark, d), "model_frame")
    m = M.fit(spark, d, frame)
    return frame.agg(F.count(F.lit(1)).alias("frame_rows")).select(
        F.lit(m.converged).alias("converged"), F.lit(m.iterations).alias("iterations"), F.lit(m.grad_norm).alias("max_score"),
        F.lit(m.extra["n"]).cast("bigint").alias("rows_used"), (F.col("frame_rows") - F.lit(m.extra["n"])).cast("bigint").alias("rows_left_out"))
