"""Cleaning, quality and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracle as O
from . import panel as P
from .queries import register
from ..functions import clean as cl
from ..operators import weights as wt
from ..session import materialize
from ..sources import catalog as cat
from ..sources import tables as tb

W = O.with_ctes

RAW_SQL = """
WITH raw AS (
  SELECT event_id, user_id,
         CASE WHEN value < 2.0 THEN '*' WHEN event_type = 'error' THEN ''
              ELSE ' ' || chr(9) || CAST(value AS VARCHAR) || chr(160) END AS raw_value
  FROM events
), parsed AS (
  SELECT *, trim(raw_value, ' ' || chr(9) || chr(160)) AS s FROM raw
)
"""
NUM_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


@register("clean_measure", RAW_SQL + f"""
SELECT event_id,
       CASE WHEN regexp_matches(s, '{NUM_RE}') THEN TRY_CAST(s AS DOUBLE) END AS parsed_value,
       CASE WHEN regexp_matches(s, '{NUM_RE}') AND abs(TRY_CAST(s AS DOUBLE)) < 9.2e18
            THEN CAST(trunc(TRY_CAST(s AS DOUBLE)) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS measure
FROM parsed""", ["parsed_value"])
def q_clean_measure(spark, d):
    """Suppressed-count text to a number (P5, P8, P10): '*', blank and
    unparsable -> 0, else truncated toward zero."""
    raw = tb.raw_text_measure(spark, d)
    return raw.select("event_id", cl.to_number("raw_value").alias("parsed_value"),
                      cl.clean_measure("raw_value").alias("measure"))


CODE_SQL = """
WITH raw AS (
  SELECT c_custkey, c_nationkey,
         CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'FURNITURE' THEN 'n/a' ELSE c_name END AS raw_code
  FROM customer
), digits AS (
  SELECT *, array_to_string(regexp_extract_all(COALESCE(raw_code, ''), '[0-9]'), '') AS dg FROM raw
)
SELECT c_custkey, raw_code, right('00000' || dg, 5) AS unit_code,
       right('00000' || c_nationkey, 5) AS padded_code,
       right('00' || c_nationkey, 2) || right('000' || (c_custkey % 1000), 3) AS composed_code,
       length(right('00000' || dg, 5)) = 5 AS valid_length
FROM digits"""


@register("normalize_code", CODE_SQL)
def q_normalize_code(spark, d):
    """Unit codes: digits only, last five, zero-padded (P11); padded from a
    number (P12); composed from two parts (P13); length check (P14)."""
    cu = tb.read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_name", "c_acctbal", "c_mktsegment")
    raw = F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string")).when(
        F.col("c_mktsegment") == "FURNITURE", F.lit("n/a")).otherwise(F.col("c_name"))
    df = cu.withColumn("raw_code", raw).withColumn("unit_code", cl.normalize_code("raw_code"))
    return df.select("c_custkey", "raw_code", "unit_code", cl.pad_code("c_nationkey").alias("padded_code"),
                     cl.compose_code("c_nationkey", F.col("c_custkey") % 1000).alias("composed_code"),
                     (F.length("unit_code") == 5).alias("valid_length"))


@register("normalize_key", """
SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN upper(s_name) END AS entity_key FROM supplier""")
def q_normalize_key(spark, d):
    """Entity keys trimmed of all whitespace (no-break spaces too) and
    upper-cased; blank -> null (P5, P6, H8)."""
    su = tb.read(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    raw = F.when(F.col("s_acctbal") < 0, F.lit(" \u00a0")).otherwise(
        F.concat(F.lit("\t\u00a0 "), F.lower("s_name"), F.lit("  ")))
    return su.select("s_suppkey", cl.normalize_key(raw).alias("entity_key"))


@register("completeness", W("ratings") + """
SELECT COUNT(*) AS total, COUNT(rating) AS non_null, COUNT(*) - COUNT(rating) AS null_count,
       CASE WHEN COUNT(*) > 0 THEN COUNT(rating) / COUNT(*) ELSE 0.0 END AS share
FROM ratings""", ["share"])
def q_completeness(spark, d):
    """Total, non-null, null and share of the rating column."""
    return cat.completeness(P.ratings(spark, d), "rating")


@register("panel_rows_by_period", W("panel") + "SELECT period, COUNT(*) AS rows FROM panel GROUP BY 1")
def q_panel_rows(spark, d):
    """Row count per period of the unit panel."""
    return P.unit_panel(spark, d).groupBy(tb.PERIOD).agg(F.count(F.lit(1)).alias("rows"))


@register("distinct_units", W("weights") + """
SELECT period, COUNT(DISTINCT unit_code) AS units, COUNT(DISTINCT entity_id) AS entities, COUNT(*) AS rows
FROM weights GROUP BY 1""")
def q_distinct_units(spark, d):
    """Distinct units and entities per period."""
    return P.share_weights(spark, d).groupBy(tb.PERIOD).agg(
        F.count_distinct(tb.UNIT).alias("units"), F.count_distinct(tb.ENTITY).alias("entities"),
        F.count(F.lit(1)).alias("rows"))


@register("sample_entity_weights", W("weights") + """
SELECT entity_id, period, unit_code, measure, weight
FROM weights QUALIFY dense_rank() OVER (ORDER BY entity_id, period) = 1
ORDER BY weight DESC, unit_code LIMIT 20""", ["weight"])
def q_sample_entity_weights(spark, d):
    """Heaviest 20 units of the first entity-period, chosen by a scalar
    subquery over the facts (J9, O2); an ordered choice instead of an
    unordered LIMIT 1 (H20)."""
    rows = tb.fact_rows(spark, d).filter((F.col("qty") > 0) & F.col(tb.UNIT).isNotNull())
    first = rows.filter(F.col(tb.ENTITY).isNotNull() & F.col(tb.PERIOD).isNotNull()).agg(
        F.min(F.struct(tb.ENTITY, tb.PERIOD))).scalar()
    mine = rows.filter(F.struct(tb.ENTITY, tb.PERIOD) == first)
    panel = materialize(wt.aggregate_panel(mine, [*P.KEYS, tb.UNIT], "qty", tb.MEASURE), "one_panel")
    return (wt.share_weights(panel, P.KEYS, tb.MEASURE).orderBy(F.col("weight").desc(), F.col(tb.UNIT)).limit(20)
            .select(tb.ENTITY, tb.PERIOD, tb.UNIT, "measure", "weight"))
