"""Panel inputs derived from the provided TPC-H style tables.

The mapping (entity = supplier, period = order year, unit = customer,
measure = quantity) is the stand-in described in FIXTURES.md section 4.  Every
frame here is a lazy plan over the parquet scans, so its cost grows with the
tables; only the needed columns are read (column pruning reaches the scan).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import pad_code

ENTITY, PERIOD, UNIT, MEASURE = "entity_id", "period", "unit_code", "measure"

# Fixed values of the stand-in mapping (FIXTURES.md section 4).
URGENT_PRIORITY = "1-URGENT"
PENDING_STATUS = "P"        # orders that do not count towards a rate
MIN_RATED_ROWS = 60         # an entity-period with fewer rows has no rating
UNIT_WIDTH = 19             # characters of a unit code: every key of 64 bits fits
CODE_STEP = 1250            # width of a band of the static code
SCORE_STEP, SCORE_MAX = 20_000, 25
SUPPRESSED_BELOW = 2.0      # raw measures under this are published as '*'


# Declared schemas of the provided tables (no inference on data paths: a
# declared schema also spares the footer-reading job Spark runs per read).
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if name in SCHEMAS:
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def unit_code(customer: str) -> Column:
    """The code of a unit: a customer's key, padded."""
    return pad_code(customer, UNIT_WIDTH)


def unit_key(customer: str) -> Column:
    """A number for each unit code, for plans that join and group by units and
    put out none: eight bytes, sorted by themselves, where the padded codes of a
    table begin with the same characters.  Codes are cut at ``UNIT_WIDTH``
    characters, so keys of 19 digits and a sign share theirs with a shorter one."""
    return F.expr(f"if({customer} <= -1000000000000000000L, {customer} div 10, {customer})")


def fact_rows(spark: SparkSession, sf_dir: str, unit: Callable[[str], Column] = unit_code) -> DataFrame:
    """One row per line item: entity, period, unit (the ordering customer, by
    its code or :func:`unit_key`), quantity and flag.  These are the 'plan rows'
    that A1 sums."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_returnflag")
    od = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias(PERIOD), unit("o_custkey").alias(UNIT))
    # an order is a few bytes: its side of a partition is hashed, the line items need no sort
    return li.join(od.hint("shuffle_hash"), li.l_orderkey == od.o_orderkey).select(
        F.col("l_suppkey").alias(ENTITY), PERIOD, UNIT,
        F.col("l_quantity").alias("qty"), F.col("l_returnflag").alias("flag"))


def fact_counts() -> dict:
    """Row counts carried alongside the measure (input of the rating)."""
    return {"rows": F.count(F.lit(1)), "returned": F.count_if(F.col("flag") == "R")}


def ratings_from_counts(counts: DataFrame) -> DataFrame:
    """Per entity-period rating on seven half-step levels 2.0 .. 5.0 from
    the unit-level row counts (so it shares the fact scan and join).

    rating = 2.0 + 0.5 * clamp(((100 * R) div n - 19) div 4, 0, 6), R the
    returned rows; null where the entity-period has too few rows to rate."""
    per = counts.groupBy(ENTITY, PERIOD).agg(F.sum("rows").alias("n"), F.sum("returned").alias("r"))
    step = F.least(F.greatest(F.expr("((100 * r) div n - 19) div 4"), F.lit(0)), F.lit(6))
    rating = F.when(F.col("n") >= MIN_RATED_ROWS, F.lit(2.0) + F.lit(0.5) * step.cast("double"))
    return per.select(ENTITY, PERIOD, rating.alias("rating"))


def period_rates(spark: SparkSession, sf_dir: str, unit: Callable[[str], Column] = unit_code) -> DataFrame:
    """Period-varying unit rate (the lagged indicator): per customer and
    year, 100 x share of urgent orders among those not pending.  A customer
    without orders in a year has no row, one with pending orders alone a
    null rate."""
    od = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    settled = F.col("o_orderstatus") != PENDING_STATUS
    urgent = F.when(F.col("o_orderpriority") == URGENT_PRIORITY, 1.0).otherwise(0.0)
    return (od.groupBy(F.year("o_orderdate").alias(PERIOD), unit("o_custkey").alias(UNIT))
            .agg((F.lit(100.0) * F.avg(F.when(settled, urgent))).alias("rate")))


def unit_attributes_long(spark: SparkSession, sf_dir: str, unit: Callable[[str], Column] = unit_code) -> DataFrame:
    """Long attribute rows per unit, values as text (input of the pivot A10):
    CODE, the band of a balance that is not negative, and POP, the number of
    orders of a customer that has any."""
    cu = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    pop = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("pop"))
    base = cu.join(pop, cu.c_custkey == pop.o_custkey, "left")
    code = F.when(F.col("c_acctbal") >= 0, (F.floor(F.col("c_acctbal") / CODE_STEP) + 1).cast("string"))
    rows = F.array(
        F.struct(F.lit("CODE").alias("attribute"), code.alias("value")),
        F.struct(F.lit("POP").alias("attribute"), F.col("pop").cast("string").alias("value")),
    )
    return base.select(
        unit("c_custkey").alias(UNIT),
        F.col("c_nationkey").cast("string").alias("state"),
        F.translate("c_name", "uo#", "üö°").alias("unit_name"),
        F.inline(F.filter(rows, lambda r: r["value"].isNotNull())),
    )


def scored_areas(spark: SparkSession, sf_dir: str, unit: Callable[[str], Column] = unit_code) -> DataFrame:
    """Scored-area rows (the orders of a unit) for the weighted score with
    fallback: finished orders are designated, open ones withdrawn, pending
    ones have no status; a negative balance is no population."""
    od = read(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    cu = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    status = F.when(F.col("o_orderstatus") == "F", "Designated").when(F.col("o_orderstatus") == "O", "Withdrawn")
    return od.join(cu, od.o_custkey == cu.c_custkey).select(
        unit("o_custkey").alias(UNIT),
        F.col("c_mktsegment").alias("area_class"),
        status.alias("status"),
        F.col("o_orderpriority").alias("area_type"),
        F.col("c_nationkey").alias("state"),
        F.least(F.lit(SCORE_MAX), F.floor(F.col("o_totalprice") / SCORE_STEP)).cast("double").alias("score"),
        F.col("c_acctbal").alias("population"),
    )


def raw_text_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measure as raw text for cleaning: small values suppressed ('*'),
    those of errors blank, all others between spaces and a tab."""
    ev = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    raw = (F.when(F.col("value") < SUPPRESSED_BELOW, F.lit("*"))
           .when(F.col("event_type") == "error", F.lit(""))
           .otherwise(F.concat(F.lit(" \t"), F.col("value").cast("string"), F.lit("\u00a0"))))
    return ev.select("event_id", "user_id", raw.alias("raw_value"))
