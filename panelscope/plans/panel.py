"""The panel pipeline over the provided tables, stage by stage.

Each function is a lazy ``DataFrame`` plan; nothing is collected.  Stages are
named after what they compute, and the registry in ``queries.py`` exposes
them (and their diagnostics) by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import contains_ci, equals_or_blank
from ..operators import concentration as conc
from ..operators import exposure as ex
from ..operators import threshold as th
from ..operators import weights as wt
from ..session import materialize
from ..sources import tables as tb

KEYS = [tb.ENTITY, tb.PERIOD]
RATE_LAG = 1          # a period uses the unit rate of the period before (J1)
RURAL_CUT = 4         # ordinal code >= 4 flags the unit (P22)
TOP = 5               # units in the top share (W3)
AREA_TYPE = "High"    # the type of scored area that counts, in any case (P18)


def unit_counts(spark: SparkSession, sf_dir: str, unit=tb.unit_code) -> DataFrame:
    """entity x period x unit measure plus row counts, one pass (A1)."""
    return wt.aggregate_panel(tb.fact_rows(spark, sf_dir, unit), [tb.ENTITY, tb.PERIOD, tb.UNIT], "qty", tb.MEASURE,
                              extra=tb.fact_counts())


def unit_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity x period x unit measure (A1)."""
    return unit_counts(spark, sf_dir).select(tb.ENTITY, tb.PERIOD, tb.UNIT, tb.MEASURE)


def staged_counts(spark: SparkSession, sf_dir: str, unit=tb.unit_code) -> DataFrame:
    """``unit_counts`` written once: what reads the facts more than once (the
    weights, their totals, the ratings) starts from here, so the line items
    are scanned and shuffled a single time."""
    return materialize(unit_counts(spark, sf_dir, unit), "unit_counts")


def ratings(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None) -> DataFrame:
    """Rating per entity-period, from the unit-level aggregate ``counts`` or
    sums of it."""
    return tb.ratings_from_counts(unit_counts(spark, sf_dir) if counts is None else counts)


def share_weights(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None, totals: DataFrame | None = None) -> DataFrame:
    """Unit share of each entity-period's measure (W1); the panel is read
    for the totals and for the shares, so it is written once."""
    counts = staged_counts(spark, sf_dir) if counts is None else counts
    return wt.share_weights(counts.select(tb.ENTITY, tb.PERIOD, tb.UNIT, tb.MEASURE), KEYS, tb.MEASURE, totals=totals)


def rate_joined(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None) -> DataFrame:
    """Weights joined to the unit rate of the previous period."""
    return ex.attach_unit_values(share_weights(spark, sf_dir, counts), tb.period_rates(spark, sf_dir), ["rate"],
                                 unit=tb.UNIT, period=tb.PERIOD, lag=RATE_LAG)


def rate_exposure(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None) -> DataFrame:
    """Renormalised lagged exposure per entity-period (A2)."""
    return ex.exposure(rate_joined(spark, sf_dir, counts), KEYS, "rate", "rate_exposure")


def unit_codes(spark: SparkSession, sf_dir: str, unit=tb.unit_code) -> DataFrame:
    """Wide unit attributes with the null-preserving flag."""
    wide = ex.pivot_attributes(tb.unit_attributes_long(spark, sf_dir, unit), tb.UNIT,
                               {"code": ("CODE", "int"), "population": ("POP", "bigint")},
                               carry=["state", "unit_name"])
    return ex.add_ordinal_flag(wide, "code", "code_flag", RURAL_CUT)


def static_exposure(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None) -> DataFrame:
    """Exposure to the static unit flag, renormalised."""
    joined = ex.attach_unit_values(share_weights(spark, sf_dir, counts), unit_codes(spark, sf_dir), ["code_flag"],
                                   unit=tb.UNIT, period=None)
    return ex.exposure(joined, KEYS, "code_flag", "static_exposure")


def unit_scores(spark: SparkSession, sf_dir: str, unit=tb.unit_code) -> DataFrame:
    """Designated scored areas of one type, in the states numbered 1 to 56,
    reduced to one score per unit (A20, P16, P17, P18)."""
    rows = tb.scored_areas(spark, sf_dir, unit)
    keep = (equals_or_blank("status", "Designated") & contains_ci("area_type", AREA_TYPE)
            & F.col("state").between(1, 56) & F.col(tb.UNIT).isNotNull() & F.col("score").isNotNull())
    return ex.unit_score(rows.filter(keep), tb.UNIT, "score", "population")


def score_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-filled score exposure with matched share and counts."""
    scores = unit_scores(spark, sf_dir).filter(F.col("unit_score").isNotNull())
    joined = ex.attach_unit_values(share_weights(spark, sf_dir), scores, ["unit_score"],
                                   unit=tb.UNIT, period=None)
    return ex.exposure(joined, KEYS, "unit_score", "score_exposure", missing="zero")


def rating_base(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None) -> DataFrame:
    """Ratings with the lagged exposure (J4), from one scan of the facts."""
    counts = staged_counts(spark, sf_dir) if counts is None else counts
    return th.rating_base(ratings(spark, sf_dir, counts), rate_exposure(spark, sf_dir, counts), KEYS)


def near_threshold(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None) -> DataFrame:
    """In-scope rows rated 3.5 to 4.5 with flag and band."""
    return th.near_threshold(rating_base(spark, sf_dir, counts), "rating", "rate_exposure")


def concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HHI, entropy, top-1 and top-5 shares, unit count."""
    return conc.concentration(share_weights(spark, sf_dir), KEYS)


def entity_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size per entity-period."""
    return conc.entity_size(share_weights(spark, sf_dir), KEYS)


def staged_groups(counts: DataFrame) -> DataFrame:
    """A row an entity-period of the unit counts, in one aggregate and written
    once: the row counts (ratings), the total measure (weights) and a floor of
    the ``TOP`` largest measures."""
    return materialize(wt.group_totals(counts, KEYS, tb.MEASURE, extra={
        "rows": F.sum("rows"), "returned": F.sum("returned"),
        "_floor": conc.top_k_floor(wt.positive(tb.MEASURE), tb.UNIT, k=TOP)}), "groups")


def unit_features(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None, groups: DataFrame | None = None) -> DataFrame:
    """Every per-entity-period feature in one grouped aggregate (A2, A4,
    A12, A22): the three unit tables are packed into one row a unit, the
    weights joined to it once (no shuffle of the weights when it is measured
    small, one by unit when not, which splits where a unit is skewed) and then
    shuffled once on (entity, period).  Only the top-5 share needs its own
    (salted) ranking pass, over the units that reach a floor of the top 5.

    No unit is put out, so ``counts`` and the unit tables go by ``tb.unit_key``;
    ``groups`` (:func:`staged_groups`) holds the totals and floors."""
    counts = staged_counts(spark, sf_dir, tb.unit_key) if counts is None else counts
    groups = staged_groups(counts) if groups is None else groups
    # weights are positive by construction
    base = share_weights(spark, sf_dir, counts, groups.select(*KEYS, "total_measure", "_floor"))
    scores = unit_scores(spark, sf_dir, tb.unit_key).filter(F.col("unit_score").isNotNull())
    packed = ex.pack_unit_values(tb.period_rates(spark, sf_dir, tb.unit_key), "rate",
                                 [(unit_codes(spark, sf_dir, tb.unit_key), "code_flag"), (scores, "unit_score")], tb.UNIT, tb.PERIOD)
    w = ex.attach_packed(base, packed, "rate", tb.UNIT, tb.PERIOD, lag=RATE_LAG)
    a_rate, f_rate = ex.exposure_parts("rate", "rate_exposure")
    a_code, f_code = ex.exposure_parts("code_flag", "static_exposure")
    a_score, f_score = ex.exposure_parts("unit_score", "score_exposure", missing="zero", matched="has_unit_score")
    aggs = a_rate + a_code + a_score + conc.concentration_aggs() + [
        F.max(F.col("total_measure").cast("double")).alias("total_size")]
    g = w.groupBy(*KEYS).agg(*aggs).select(
        *KEYS, f_rate[0], f_code[0], f_score[0], "hhi", "entropy", "top1_share",
        F.col("n_units").cast("double").alias("n_units"), "total_size")
    # a larger measure is no smaller weight, so the floor holds for the weights
    high = base.filter(F.col("_floor").isNull() | (F.col(tb.MEASURE) >= F.col("_floor")))
    top = conc.top_k_sum(high, KEYS, "weight", tb.UNIT, k=TOP, out="top5_share")
    return g.join(top, KEYS, "left")


FRAME_COLS = [tb.ENTITY, tb.PERIOD, "rating", "rate_exposure", "static_exposure", "score_exposure", "hhi",
              "entropy", "top1_share", "top5_share", "n_units", "total_size"]


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating plus every feature, one row per rated entity-period.

    The features come from one fused aggregate (``unit_features``), so the
    frame is the ratings left-joined once on (entity, period); the facts
    are scanned once."""
    counts = staged_counts(spark, sf_dir, tb.unit_key)
    groups = staged_groups(counts)
    s = ratings(spark, sf_dir, groups).filter(F.col("rating").isNotNull())
    return s.join(unit_features(spark, sf_dir, counts, groups), KEYS, "left").select(*FRAME_COLS)
