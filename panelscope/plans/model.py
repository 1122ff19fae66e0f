"""Model stages over the panel: sample, ordered-logit fit, decomposition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ordinal as od
from ..session import materialize
from ..sources import tables as tb
from . import panel as P

CORE = ["rate_exposure", "static_exposure", "score_exposure", "hhi", "entropy",
        "top1_share", "top5_share", "n_units"]
FEATURES = CORE + ["log_size"]

# Scoring parameters used by the value-checked report queries
# (rounded from an ordered-logit fit of the sf0.01 panel).  Levels are the
# seven rating steps; slopes are per original-scale feature; period effects
# are added to the linear predictor for the named period.
FIXED_LEVELS = [2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0]
FIXED_THRESHOLDS = [-3.6, -1.9, -0.6, 0.5, 1.6, 3.0]
FIXED_SLOPES = {
    "rate_exposure": 0.02, "static_exposure": -0.3, "score_exposure": 0.05, "hhi": 1.5,
    "entropy": 0.2, "top1_share": -2.0, "top5_share": 1.0, "n_units": -0.02, "log_size": 0.1,
}
FIXED_PERIOD_EFFECTS = {1997: 0.1, 1998: -0.1, 1999: 0.2, 2000: -0.2, 2001: 0.05}


def sample(spark: SparkSession, sf_dir: str, frame: DataFrame | None = None):
    """(sample with period dummies, levels, feature names)."""
    frame = P.model_frame(spark, sf_dir) if frame is None else frame
    s, levels, periods = od.model_sample(frame, "rating", CORE, "total_size", tb.PERIOD)
    s, dummies = od.period_dummies(s, tb.PERIOD, periods)
    return s, levels, FEATURES + dummies


def fit(spark: SparkSession, sf_dir: str, frame: DataFrame | None = None) -> od.OrderedLogit:
    s, levels, feats = sample(spark, sf_dir, frame)
    return od.fit_ordered_logit(s, "level_index", feats, levels)


OUT_COLS = [tb.ENTITY, tb.PERIOD, "rating", "expected_rating", "residual", *CORE, "total_size", "log_size"]


def decomposition(spark: SparkSession, sf_dir: str, model: od.OrderedLogit | None = None) -> DataFrame:
    """Fitted decomposition (M12): observed, expected, residual, features."""
    s, levels, feats = sample(spark, sf_dir)
    m = model or od.fit_ordered_logit(s, "level_index", feats, levels)
    return materialize(od.decompose(s, m, "rating", [tb.ENTITY, tb.PERIOD]).select(*OUT_COLS), "decomposition")


def fixed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model rows (M14) with the fixed period effect as a column."""
    s, _, _ = od.model_sample(P.model_frame(spark, sf_dir), "rating", CORE, "total_size", tb.PERIOD,
                              checkpoint=False, index_levels=False)
    eff = F.lit(0.0)
    for p, v in FIXED_PERIOD_EFFECTS.items():
        eff = F.when(F.col(tb.PERIOD) == p, F.lit(v)).otherwise(eff)
    return s.withColumn("period_effect", eff)


def fixed_model() -> od.OrderedLogit:
    slopes = dict(FIXED_SLOPES)
    slopes["period_effect"] = 1.0
    return od.fixed_model(FIXED_LEVELS, FIXED_THRESHOLDS, slopes)


def decomposition_fixed(spark: SparkSession, sf_dir: str, staged: bool = False) -> DataFrame:
    """Decomposition at the fixed parameters: the input of every report
    query, so those are value-checked end to end.  Lazy, so a report's
    columns and filters reach it; ``staged`` writes it once for reports that
    read it more than once."""
    out = od.decompose(fixed_sample(spark, sf_dir), fixed_model(), "rating", [tb.ENTITY, tb.PERIOD]).select(*OUT_COLS)
    return materialize(out, "decomposition") if staged else out
