"""Registry of named queries: a Spark plan and, where SQL can say it, the
independent DuckDB oracle.

``register(name, sql=..., doubles=...)`` records both.  Spark results have
every double column rounded to 6 places (``finish``); the oracle rounds the
columns listed in ``doubles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from . import oracle as O
from . import panel as P
from ..operators import exposure as ex
from ..operators import threshold as th
from ..operators.quantiles import exact_quantiles
from ..operators import weights as wt
from ..session import materialize
from ..sources import tables as tb

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def finish(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every floating column, so float sums that differ only in
    shuffle order compare equal; values that lie on a half go up, however
    the last bit fell."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f.name) + O.TIE, places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None, doubles: list[str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = lambda spark, sf_dir: finish(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = O.r6(sql, doubles or [])
        return fn
    return deco


K = P.KEYS
WITH = O.with_ctes

# ------------------------------------------------------------ panel, weights

@register("unit_panel", WITH("panel") + "SELECT entity_id, period, unit_code, measure FROM panel")
def q_unit_panel(spark, d):
    return P.unit_panel(spark, d)


@register("share_weights",
          WITH("weights") + "SELECT entity_id, period, unit_code, measure, total_measure, weight FROM weights",
          ["weight"])
def q_share_weights(spark, d):
    return P.share_weights(spark, d).select(*K, tb.UNIT, "measure", "total_measure", "weight")


@register("weight_sum_qc", WITH("portfolios") + """
SELECT period, count(*) AS groups_checked, avg(one) AS avg_weight_sum, min(one) AS min_weight_sum, max(one) AS max_weight_sum
FROM (SELECT period, list_sum(list_transform(units, lambda u: u.m / total)) AS one FROM portfolios)
GROUP BY period""", ["avg_weight_sum", "min_weight_sum", "max_weight_sum"])
def q_weight_sum_qc(spark, d):
    return wt.weight_sum_qc(P.share_weights(spark, d), K, tb.PERIOD)


# ------------------------------------------------------------ lagged exposure

@register("lagged_exposure", WITH("rate_exposure") + """
SELECT entity_id, period, total_measure, rate_exposure, coverage_weight_share, out_of_scope
FROM rate_exposure""", ["rate_exposure", "coverage_weight_share"])
def q_lagged_exposure(spark, d):
    return P.rate_exposure(spark, d)


@register("missing_share", WITH("rate_joined") + """
SELECT entity_id, period, coalesce(sum(weight) FILTER (matched = 0), 0) AS missing_share,
       count(*) FILTER (matched = 1) AS matched_rows
FROM rate_joined GROUP BY entity_id, period""", ["missing_share"])
def q_missing_share(spark, d):
    return ex.missing_share(P.rate_joined(spark, d), K)


@register("out_of_scope", WITH("rate_joined") + """
SELECT entity_id, period, sum(weight) AS missing_share FROM rate_joined
GROUP BY entity_id, period HAVING max(matched) = 0""", ["missing_share"])
def q_out_of_scope(spark, d):
    return ex.fully_unmatched(P.rate_joined(spark, d), K)


@register("match_rate", WITH("rate_joined") + """
SELECT period, count(*) AS weight_rows, count(*) - sum(matched)::BIGINT AS missing_rows, avg(matched) AS match_rate
FROM rate_joined GROUP BY period""", ["match_rate"])
def q_match_rate(spark, d):
    return ex.match_rate(P.rate_joined(spark, d), tb.PERIOD)


@register("coverage_summary", WITH("rate_exposure") + """
SELECT period, count(*) AS groups, count(*) FILTER (coverage_weight_share = 0) AS out_of_scope_count,
       avg(coverage_weight_share) AS avg_coverage, min(coverage_weight_share) AS min_coverage, max(coverage_weight_share) AS max_coverage
FROM rate_exposure GROUP BY period""",
          ["avg_coverage", "min_coverage", "max_coverage"])
def q_coverage_summary(spark, d):
    return ex.coverage_summary(P.rate_exposure(spark, d), tb.PERIOD)


@register("heaviest_units", WITH("rate_exposure") + """
SELECT entity_id, period, rate_exposure FROM rate_exposure WHERE out_of_scope = 0
ORDER BY period, rate_exposure DESC, entity_id LIMIT 10""", ["rate_exposure"])
def q_heaviest_units(spark, d):
    """Top-10 report of the highest exposures (O2): the limit is the feature."""
    e = P.rate_exposure(spark, d).filter(F.col("out_of_scope") == 0)
    return (e.orderBy(F.col(tb.PERIOD).asc(), F.col("rate_exposure").desc(), F.col(tb.ENTITY).asc())
            .limit(10).select(*K, "rate_exposure"))


# ------------------------------------------------------------ static indicator

@register("pivot_attributes", WITH("unit_codes") + """
SELECT unit_code, state, unit_name, code, population, code_flag FROM unit_codes""")
def q_pivot_attributes(spark, d):
    return P.unit_codes(spark, d).select(tb.UNIT, "state", "unit_name", "code", "population", "code_flag")


@register("code_distribution", WITH("unit_codes") + """
SELECT code, count(*) AS units, if(code IS NULL, count(*), 0) AS missing_code FROM unit_codes GROUP BY code""")
def q_code_distribution(spark, d):
    return P.unit_codes(spark, d).groupBy("code").agg(
        F.count(F.lit(1)).alias("units"),
        F.sum(F.when(F.col("code").isNull(), 1).otherwise(0)).cast("bigint").alias("missing_code"))


@register("static_exposure", WITH("static_exposure") + """
SELECT entity_id, period, total_measure, static_exposure, coverage_weight_share, out_of_scope
FROM static_exposure""", ["static_exposure", "coverage_weight_share"])
def q_static_exposure(spark, d):
    return P.static_exposure(spark, d)


# ------------------------------------------------------------ scored areas

@register("unit_score_fallback", WITH("unit_scores") + """
SELECT unit_code, unit_score, unit_flag, source_rows, weight_method FROM unit_scores""", ["unit_score"])
def q_unit_score(spark, d):
    return P.unit_scores(spark, d)


@register("zero_filled_exposure", WITH("score_exposure") + """
SELECT entity_id, period, score_exposure, matched_weight_share, units_total, units_matched
FROM score_exposure""", ["score_exposure", "matched_weight_share"])
def q_zero_filled(spark, d):
    return P.score_exposure(spark, d)


@register("share_percentiles", WITH("score_exposure") + """
SELECT AVG(matched_weight_share) AS avg_share,
       quantile_cont(matched_weight_share, 0.5) AS p50_share,
       quantile_cont(matched_weight_share, 0.9) AS p90_share,
       MAX(matched_weight_share) AS max_share
FROM score_exposure""", ["avg_share", "p50_share", "p90_share", "max_share"])
def q_share_percentiles(spark, d):
    """Mean, median, 90th percentile and max of the matched share."""
    e = materialize(P.score_exposure(spark, d).select("matched_weight_share"), "score_exposure")
    s = F.col("matched_weight_share")
    # the two quantiles join the one-row moments as one scalar subquery
    q = exact_quantiles(e, "matched_weight_share", [0.5, 0.9]).agg(
        F.map_from_entries(F.collect_list(F.struct("p_index", "q")))).scalar()
    return e.agg(F.avg(s).alias("avg_share"), F.max(s).alias("max_share")).withColumn("_q", q).select(
        "avg_share", F.col("_q")[0].alias("p50_share"), F.col("_q")[1].alias("p90_share"), "max_share")


# ------------------------------------------------------------ threshold slice

@register("rating_base", WITH("rating_base") + """
SELECT entity_id, period, rating, total_measure, rate_exposure, coverage_weight_share, out_of_scope
FROM rating_base""", ["rating", "rate_exposure", "coverage_weight_share"])
def q_rating_base(spark, d):
    return P.rating_base(spark, d).select(*K, "rating", "total_measure", "rate_exposure",
                                          "coverage_weight_share", "out_of_scope")


@register("near_threshold", WITH("near") + """
SELECT entity_id, period, rating, total_measure, rate_exposure, above_threshold, threshold_band
FROM near""", ["rating", "rate_exposure"])
def q_near_threshold(spark, d):
    return P.near_threshold(spark, d).select(*K, "rating", "total_measure", "rate_exposure",
                                             "above_threshold", "threshold_band")


@register("band_counts", WITH("near") + """
SELECT period, threshold_band, count(*) AS entities, sum(total_measure) AS total_size FROM near GROUP BY ALL""")
def q_band_counts(spark, d):
    return th.band_counts(P.near_threshold(spark, d), tb.PERIOD)


@register("band_means", WITH("near") + """
SELECT period, threshold_band, avg(rate_exposure) AS mean_value, sum(rate_exposure * total_measure) / sum(total_measure) AS weighted_mean_value
FROM near GROUP BY period, threshold_band""", ["mean_value", "weighted_mean_value"])
def q_band_means(spark, d):
    return th.band_means(P.near_threshold(spark, d), tb.PERIOD, "rate_exposure")


BAND_DIFF_SQL = WITH("near") + """
SELECT period, lo AS ew_mean_low, hi AS ew_mean_high, lo - hi AS diff_low_minus_high
FROM (SELECT period, sum(rate_exposure * total_measure) FILTER (rating < 4) / sum(total_measure) FILTER (rating < 4) AS lo,
             sum(rate_exposure * total_measure) FILTER (rating >= 4) / sum(total_measure) FILTER (rating >= 4) AS hi
      FROM near GROUP BY period)
WHERE lo + hi IS NOT NULL"""


@register("band_difference", BAND_DIFF_SQL, ["ew_mean_low", "ew_mean_high", "diff_low_minus_high"])
def q_band_difference(spark, d):
    return th.band_difference(P.near_threshold(spark, d), tb.PERIOD, "rate_exposure")


# ------------------------------------------------------------ concentration, frame

@register("concentration", WITH("concentration") + """
SELECT entity_id, period, hhi, entropy, top1_share, top5_share, n_units FROM concentration""",
          ["hhi", "entropy", "top1_share", "top5_share"])
def q_concentration(spark, d):
    return P.concentration(spark, d)


@register("entity_size", WITH("entity_size") + "SELECT entity_id, period, total_size FROM entity_size",
          ["total_size"])
def q_entity_size(spark, d):
    return P.entity_size(spark, d)


MODEL_FRAME_DOUBLES = ["rating", "rate_exposure", "static_exposure", "score_exposure", "hhi", "entropy",
                       "top1_share", "top5_share", "n_units", "total_size"]


@register("model_frame", WITH("model_frame") + """
SELECT entity_id, period, rating, rate_exposure, static_exposure, score_exposure, hhi, entropy,
       top1_share, top5_share, n_units, total_size FROM model_frame""", MODEL_FRAME_DOUBLES)
def q_model_frame(spark, d):
    return P.model_frame(spark, d)


# ------------------------------------------------------------ ranked lists, missing exposures

@register("highest_static_exposure", WITH("static_exposure") + """
SELECT entity_id, period, static_exposure FROM static_exposure WHERE out_of_scope = 0
ORDER BY period, static_exposure DESC, entity_id LIMIT 10""", ["static_exposure"])
def q_highest_static(spark, d):
    """Top-10 report of the highest static exposures (O2): the limit is the feature."""
    e = P.static_exposure(spark, d).filter(F.col("out_of_scope") == 0)
    return e.orderBy(tb.PERIOD, F.col("static_exposure").desc(), tb.ENTITY).limit(10).select(*K, "static_exposure")


@register("highest_score_exposure", WITH("score_exposure") + """
SELECT entity_id, period, score_exposure FROM score_exposure
ORDER BY period, score_exposure DESC, entity_id LIMIT 10""", ["score_exposure"])
def q_highest_score(spark, d):
    """Top-10 report of the highest score exposures (O2): the limit is the feature."""
    e = P.score_exposure(spark, d)
    return e.orderBy(tb.PERIOD, F.col("score_exposure").desc(), tb.ENTITY).limit(10).select(*K, "score_exposure")


@register("missing_exposures", WITH("near", "static_exposure") + """
SELECT period, count(*) AS rows, count(*) FILTER (x IS NULL) AS missing_static
FROM (SELECT period, (SELECT any_value(s.static_exposure) FROM static_exposure s
                      WHERE s.entity_id = n.entity_id AND s.period = n.period) AS x FROM near n)
GROUP BY period""")
def q_missing_exposures(spark, d):
    """Near-threshold rows without a static exposure, per period (A5)."""
    counts = P.staged_counts(spark, d)
    r = P.static_exposure(spark, d, counts).select(*K, "static_exposure")
    return P.near_threshold(spark, d, counts).join(r, K, "left").groupBy(tb.PERIOD).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("static_exposure").isNull()).alias("missing_static"))
