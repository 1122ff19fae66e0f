"""Weighted exposures from unit indicators.

A unit table (``unit`` plus optional ``period``) is left-joined to the
weights once, with an optional period lag; every diagnostic is then a
conditional sum over that one join.  Unit tables are dimensions: Spark picks
a broadcast when their measured size is under the broadcast threshold (at
plan time from file statistics, or at run time through AQE) and a shuffle
join otherwise; nothing here forces a broadcast of an unmeasured side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import ordinal_flag

MATCHED = "_matched"


def attach_unit_values(weights: DataFrame, values: DataFrame, value_cols: Sequence[str],
                       unit: str = "unit_code", period: str | None = "period", lag: int = 0) -> DataFrame:
    """Left join of weights to a unit table (J1 with ``lag``, J2 when
    ``period`` is None).  Adds ``_matched`` = 1 when a unit row was found,
    so an absent row and a null value stay distinguishable (H12)."""
    right = values.select(
        F.col(unit).alias("_u"),
        *([F.col(period).alias("_p")] if period else []),
        *[F.col(c) for c in value_cols],
        F.lit(1).alias(MATCHED),
    )
    cond = F.col(unit) == F.col("_u")
    left = weights
    if period:
        left = left.withColumn("_lagp", F.col(period) - F.lit(lag))
        cond = cond & (F.col("_lagp") == F.col("_p"))
    joined = left.join(right, cond, "left")
    drop = ["_u"] + (["_p", "_lagp"] if period else [])
    return joined.drop(*drop).withColumn(MATCHED, F.coalesce(F.col(MATCHED), F.lit(0)))


def pack_unit_values(by_period: DataFrame, value: str, static: Sequence[tuple[DataFrame, str]],
                     unit: str = "unit_code", period: str = "period") -> DataFrame:
    """One row a unit: ``by_period``, a map from period to ``value`` (a key with
    a null value where the row has none), and for each (table, column) of
    ``static`` the column and ``has_<column>``, whether the table has a row of
    the unit.  One grouped aggregate over all tables; each has at most one row a
    unit (and period).  Null units are left out."""
    entry = F.when(F.col("_t") == -1, F.struct(F.col(period).alias("k"), F.col(value).alias("v")))
    rows = by_period.select(F.col(unit).alias("_u"), period, value, F.lit(-1).alias("_t"))
    for i, (table, column) in enumerate(static):
        rows = rows.unionByName(table.select(F.col(unit).alias("_u"), column, F.lit(i).alias("_t")), allowMissingColumns=True)
    return rows.filter(F.col("_u").isNotNull()).groupBy("_u").agg(
        F.map_from_entries(F.collect_list(entry)).alias("by_period"), *[F.max(c).alias(c) for _, c in static],
        *[F.coalesce(F.max(F.when(F.col("_t") == i, 1)), F.lit(0)).alias(f"has_{c}") for i, (_, c) in enumerate(static)])


def attach_packed(weights: DataFrame, packed: DataFrame, value: str, unit: str = "unit_code", period: str = "period",
                  lag: int = 0) -> DataFrame:
    """Left join of the weights to :func:`pack_unit_values`, so they move once
    for all unit tables (J1-J3): ``value`` of the lagged period, the static
    columns, and ``has_`` flags (0 for a unit without a row)."""
    static = [c for c in packed.columns if c not in ("_u", "by_period")]
    key = F.col(period) - F.lit(lag)
    # a row a unit: its side of a partition is hashed, the weights need no sort
    joined = weights.join(packed.hint("shuffle_hash"), F.col(unit) == F.col("_u"), "left")
    return joined.select(*weights.columns, F.try_element_at("by_period", key).alias(value),
                         F.coalesce(F.map_contains_key("by_period", key), F.lit(False)).cast("int").alias(f"has_{value}"),
                         *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c.startswith("has_") else F.col(c) for c in static])


def exposure_parts(value: str, out: str, weight: str = "weight", missing: str = "renormalize",
                   matched: str = MATCHED) -> tuple[list, list]:
    """(aggregate expressions, final projections) of one exposure, so several
    exposures over the same join can share a single grouped aggregate."""
    v, w = F.col(value), F.col(weight)
    t = f"_{out}"
    if missing == "renormalize":
        aggs = [F.sum(F.when(v.isNotNull(), w * v).otherwise(F.lit(0.0))).alias(f"{t}_num"),
                F.sum(F.when(v.isNotNull(), w).otherwise(F.lit(0.0))).alias(f"{t}_den")]
        den = F.col(f"{t}_den")
        final = [F.when(den > 0, F.col(f"{t}_num") / den).alias(out),
                 den.alias("coverage_weight_share"),
                 F.when(den == 0, 1).otherwise(0).cast("int").alias("out_of_scope")]
        return aggs, final
    if missing == "zero":
        hit = F.col(matched) == 1
        aggs = [F.sum(w * F.coalesce(v, F.lit(0.0))).alias(out),
                F.sum(F.when(hit, w).otherwise(F.lit(0.0))).alias("matched_weight_share"),
                F.count(F.lit(1)).alias("units_total"),
                F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias("units_matched")]
        return aggs, [F.col(out), F.col("matched_weight_share"), F.col("units_total"), F.col("units_matched")]
    raise ValueError(f"unknown missing policy: {missing}")


def exposure(joined: DataFrame, keys: Sequence[str], value: str, out: str,
             weight: str = "weight", total: str | None = "total_measure",
             missing: str = "renormalize") -> DataFrame:
    """Weighted exposure per key (A2 / A4).

    ``missing="renormalize"``: mean over units with a non-null value,
    weights rescaled to those units; ``coverage_weight_share`` is the weight
    with a value, ``out_of_scope`` is 1 when it is zero.
    ``missing="zero"``: absent or null values count as 0, no rescaling;
    returns the matched weight share and unit counts."""
    aggs, final = exposure_parts(value, out, weight, missing)
    if missing == "renormalize" and total:
        aggs = [F.max(total).alias("total_measure")] + aggs
        final = [F.col("total_measure")] + final
    return joined.groupBy(*keys).agg(*aggs).select(*keys, *final)


def missing_share(joined: DataFrame, keys: Sequence[str], weight: str = "weight") -> DataFrame:
    """Weight share of units with no row in the unit table (A3); also the
    matched row count, the stable test for 'entirely unmatched' (H11)."""
    return joined.groupBy(*keys).agg(
        F.sum(F.col(weight) * (F.lit(1) - F.col(MATCHED))).alias("missing_share"),
        F.sum(F.col(MATCHED)).cast("bigint").alias("matched_rows"),
    )


def fully_unmatched(joined: DataFrame, keys: Sequence[str], weight: str = "weight") -> DataFrame:
    """Keys none of whose units matched (J7).  Decided on the integer
    matched-row count, not on float equality of a share (H11)."""
    return missing_share(joined, keys, weight).filter(F.col("matched_rows") == 0).drop("matched_rows")


def match_rate(joined: DataFrame, by: str) -> DataFrame:
    """Row-level join coverage per ``by``."""
    return joined.groupBy(by).agg(
        F.count(F.lit(1)).alias("weight_rows"),
        F.sum(F.lit(1) - F.col(MATCHED)).cast("bigint").alias("missing_rows"),
        (F.lit(1.0) - F.avg((F.lit(1) - F.col(MATCHED)).cast("double"))).alias("match_rate"),
    )


def coverage_summary(exp: DataFrame, by: str) -> DataFrame:
    """Per ``by``: count, out-of-scope count, coverage avg/min/max."""
    c = F.col("coverage_weight_share")
    return exp.groupBy(by).agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("out_of_scope").cast("bigint").alias("out_of_scope_count"),
        F.avg(c).alias("avg_coverage"),
        F.min(c).alias("min_coverage"),
        F.max(c).alias("max_coverage"),
    )


def pivot_attributes(long: DataFrame, unit: str, attributes: dict[str, tuple[str, str]],
                     carry: Sequence[str] = (), attribute: str = "attribute", value: str = "value") -> DataFrame:
    """Long to wide by conditional max of a typed value (A10).

    ``attributes`` maps output column -> (attribute name, type).  ``carry``
    columns take one value per unit; the minimum is used so the answer is
    stable across runs (A11)."""
    aggs = [F.min(c).alias(c) for c in carry]
    for out, (name, typ) in attributes.items():
        aggs.append(F.max(F.when(F.col(attribute) == name, F.col(value).try_cast(typ))).alias(out))
    return long.groupBy(unit).agg(*aggs)


def add_ordinal_flag(df: DataFrame, code: str, out: str, cut: int = 4) -> DataFrame:
    """Null-preserving flag from an ordinal code."""
    return df.withColumn(out, ordinal_flag(code, cut))


def unit_score(rows: DataFrame, unit: str, score: str, population: str) -> DataFrame:
    """Weighted score with fallback (A20): weights are populations clipped
    at 0 (missing -> 0); if their sum is positive the weighted mean, else the
    plain mean, with the method named.  One grouped aggregate."""
    w = F.greatest(F.coalesce(F.col(population), F.lit(0.0)), F.lit(0.0))
    s = F.col(score)
    g = rows.groupBy(unit).agg(
        F.sum(w).alias("_ws"),
        F.sum(w * s).alias("_wss"),
        F.avg(s).alias("_mean"),
        F.count(F.lit(1)).alias("_n"),
    )
    weighted = F.col("_ws") > 0
    return g.select(
        unit,
        F.when(weighted, F.col("_wss") / F.col("_ws")).otherwise(F.col("_mean")).alias("unit_score"),
        F.lit(1).alias("unit_flag"),
        F.col("_n").cast("int").alias("source_rows"),
        F.when(weighted, F.lit("pop_weighted")).otherwise(F.lit("simple_mean")).alias("weight_method"),
    )
