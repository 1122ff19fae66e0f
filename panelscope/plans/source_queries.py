"""Source round trips (S1, S2, S5, S6, S13): the per-period unit rate table
is landed in the file shapes the sources expect (one banner CSV and one
header-row JSON document per period, as the reference receives them), then
read back through the source operators and typed.  The landing folder is
under the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from . import panel as P
from .panel import RURAL_CUT
from .queries import register
from ..functions.clean import clean_measure, normalize_code, normalize_key, to_number
from ..session import ensure_checkpoint_dir, materialize
from ..operators import exposure as ex
from ..operators import threshold as th
from ..sources import catalog as cat
from ..sources import files as fs
from ..sources import tables as tb

RATE_SQL = O.with_ctes("rates") + "SELECT period, unit_code, rate FROM rates"


def _landing(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/panelscope/landing/{name}-{uuid.uuid4().hex}"


#: Lines of a landed document.
DOCUMENT_LINES = 10_000


#: Where the path of a landed file names its period.
PERIOD_IN_PATH = rf"/{tb.PERIOD}=([0-9]+)/"


def _land_per_period(rates: DataFrame, path: str, body_line, document) -> None:
    """Text documents of about ``DOCUMENT_LINES`` lines, one in each file,
    below a folder for each period."""
    parts = 1 + rates.count() // DOCUMENT_LINES
    docs = (rates.withColumn("part", F.pmod(F.xxhash64(tb.UNIT), F.lit(parts))).groupBy(tb.PERIOD, "part")
            .agg(F.array_sort(F.collect_list(body_line)).alias("_lines"))
            .select(tb.PERIOD, "part", document(F.col("_lines")).alias("value")))
    docs.write.mode("overwrite").partitionBy(tb.PERIOD, "part").text(path)


@register("csv_banner_roundtrip", RATE_SQL, ["rate"])
def q_csv_banner_roundtrip(spark, d):
    """Banner-first CSV per period -> skip banner, string columns, all files in
    one scan -> period from the file's path -> typed with the guarded numeric
    parse."""
    rates = tb.period_rates(spark, d)
    path = _landing(spark, "rates_csv")
    line = F.concat_ws(",", F.col(tb.UNIT), F.coalesce(F.col("rate").cast("string"), F.lit("")))
    _land_per_period(
        rates, path, line,
        lambda lines: F.concat(F.lit("Unit rates, landed extract\n"), F.lit(f"{tb.UNIT},rate\n"),
                               F.concat_ws("\n", lines)))
    raw = fs.read_csv_banner(spark, path, file_column="file")
    return raw.select(fs.period_of_file("file", PERIOD_IN_PATH).alias(tb.PERIOD), F.col(tb.UNIT), to_number("rate").alias("rate"))


@register("json_rows", RATE_SQL, ["rate"])
def q_json_rows(spark, d):
    """Array-of-arrays JSON payload per period, header first -> rows named
    by the header, all files in one scan -> period from the file's path ->
    typed."""
    rates = tb.period_rates(spark, d)
    path = _landing(spark, "rates_json")
    row = F.array(F.col(tb.UNIT), F.col("rate").cast("string"))
    _land_per_period(
        rates, path, row,
        lambda rows: F.to_json(F.concat(F.array(F.array(F.lit("UNIT"), F.lit("RATE"))), rows)))
    raw = fs.read_header_rows_json(spark, path, file_column="file")
    return raw.select(fs.period_of_file("file", PERIOD_IN_PATH).alias(tb.PERIOD), F.col("UNIT").alias(tb.UNIT),
                      to_number("RATE").alias("rate"))


@register("csv_attributes_roundtrip", O.with_ctes("unit_codes") + """
SELECT unit_code, state, unit_name, code, population, code_flag FROM unit_codes""")
def q_csv_attributes_roundtrip(spark, d):
    """Long attribute rows landed as a single-byte encoded CSV with numeric
    codes (leading zeros lost, as a typed export does), read back with a
    declared schema and re-padded codes (S3, S4, S13), then pivoted (A10)."""
    long = tb.unit_attributes_long(spark, d)
    path = _landing(spark, "attributes_csv")
    fs.write_csv(long.select(F.col(tb.UNIT).cast("bigint").alias("FIPS"), F.col("state").alias("State"),
                             F.col("unit_name").alias("County_Name"), F.col("attribute").alias("Attribute"),
                             F.col("value").alias("Value")), path, encoding="ISO-8859-1")
    schema = "FIPS bigint, State string, County_Name string, Attribute string, Value string"
    raw = fs.read_csv_typed(spark, path, schema, pad={"FIPS": tb.UNIT_WIDTH}, encoding="ISO-8859-1")
    rows = raw.select(F.col("FIPS").alias(tb.UNIT), F.col("State").alias("state"),
                      F.col("County_Name").alias("unit_name"), F.col("Attribute").alias("attribute"),
                      F.col("Value").alias("value"))
    wide = ex.pivot_attributes(rows, tb.UNIT, {"code": ("CODE", "int"), "population": ("POP", "bigint")},
                               carry=["state", "unit_name"])
    return ex.add_ordinal_flag(wide, "code", "code_flag", RURAL_CUT).select(
        tb.UNIT, "state", "unit_name", "code", "population", "code_flag")


# ------------------------------------------------------------ staging paths end to end

#: The spellings under which the raw files carry a column.
ENTITY_NAMES = ["Contract ID", "Contract Number"]
UNIT_NAMES = ["FIPS Code", "FIPS State County Code"]


def _land_enrollment(spark, d) -> str:
    """Raw files, a folder for each period: entities and units as text with
    blanks, small measures suppressed, cells parted by a bar, the columns of odd
    and even periods under different names."""
    rows = tb.fact_rows(spark, d).select(
        tb.PERIOD, F.concat(F.lit(" h"), F.col(tb.ENTITY), F.lit("\t")).alias("entity"),
        F.concat(F.lit("U-"), F.col(tb.UNIT)).alias("unit"),
        F.when(F.col("qty") < 3, F.lit("*")).when(F.col("qty") < 5, F.lit("N/A")).otherwise(F.col("qty").cast("string")).alias("n"))
    rows, path = materialize(rows, "raw_enrollment"), _landing(spark, "enrollment")
    for odd in (0, 1):
        named = rows.filter(F.col(tb.PERIOD) % 2 == odd).toDF(tb.PERIOD, ENTITY_NAMES[odd], UNIT_NAMES[odd], "Enrollment")
        fs.write_csv(named, f"{path}/{odd}", sep="|", partition_by=[tb.PERIOD])
    return path


@register("staged_enrollment", f"""
SELECT 'H' || l_suppkey AS entity_key, year(o_orderdate)::INTEGER AS period, lpad(o_custkey::VARCHAR, {tb.UNIT_WIDTH}, '0') AS unit_code,
       CAST(sum(if(l_quantity < 5, 0, trunc(l_quantity))) AS BIGINT) AS measure
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def q_staged_enrollment(spark, d):
    """String CSV with NA tokens and a delimiter, two spellings of each column
    stacked by one scan, key, code and suppressed count, summed to the panel
    (S2, S6, S14, P2, P4, P6, P10, P11, A1)."""
    raw = fs.read_csv_files(spark, _land_enrollment(spark, d), sep="|", na_tokens=True, file_column="file")
    cat.require_columns(raw, ["Enrollment"])
    either = lambda names: F.coalesce(*[F.col(f"`{n}`") for n in names if n in raw.columns])
    rows = raw.select(normalize_key(either(ENTITY_NAMES)).alias("entity_key"), fs.period_of_file("file", PERIOD_IN_PATH).alias(tb.PERIOD),
                      normalize_code(either(UNIT_NAMES), tb.UNIT_WIDTH).alias("unit_code"), clean_measure("Enrollment").alias("measure"))
    return rows.groupBy("entity_key", tb.PERIOD, "unit_code").agg(F.sum("measure").alias("measure"))


@register("enrollment_steps", """
WITH raw AS (SELECT l_suppkey, year(o_orderdate) AS period, o_custkey, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
n AS (SELECT count(*) AS raw, count(*) FILTER (l_quantity >= 5) AS kept,
             (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, period, o_custkey FROM raw WHERE l_quantity >= 5)) AS panel FROM raw)
SELECT 0 AS place, 'read' AS step, raw AS rows, 0::BIGINT AS lost FROM n
UNION ALL SELECT 1, 'typed', raw, 0 FROM n
UNION ALL SELECT 2, 'with a count', kept, raw - kept FROM n
UNION ALL SELECT 3, 'summed', panel, kept - panel FROM n""")
def q_enrollment_steps(spark, d):
    """The enrollment path with its row counts after each step, gathered while
    the panel is written and without a job of their own (S18)."""
    steps = cat.StepCounts()
    raw = steps.step(fs.read_csv_files(spark, _land_enrollment(spark, d), sep="|", na_tokens=True, file_column="file"), "read")
    either = lambda names: F.coalesce(*[F.col(f"`{n}`") for n in names if n in raw.columns])
    typed = raw.select(normalize_key(either(ENTITY_NAMES)).alias("entity_key"), fs.period_of_file("file", PERIOD_IN_PATH).alias(tb.PERIOD),
                       normalize_code(either(UNIT_NAMES), tb.UNIT_WIDTH).alias("unit_code"), clean_measure("Enrollment").alias("measure"))
    typed = steps.step(typed, "typed")
    kept = steps.step(typed.filter(F.col("measure") > 0), "with a count")
    panel = steps.step(kept.groupBy("entity_key", tb.PERIOD, "unit_code").agg(F.sum("measure").alias("measure")), "summed")
    fs.save_table(panel, "panel", path=_landing(spark, "enrollment_panel"))
    return steps.table(spark)


@register("inferred_types", O.with_ctes("unit_codes") + """
, l AS (
  SELECT unit_code AS "FIPS", state AS "State", unit_name AS "Name", 'CODE' AS "Attribute", code::VARCHAR AS "Value" FROM unit_codes WHERE code IS NOT NULL
  UNION ALL SELECT unit_code, state, unit_name, 'POP', population::VARCHAR FROM unit_codes WHERE population IS NOT NULL),
b AS (SELECT *, c_acctbal::VARCHAR AS "Balance" FROM l JOIN (SELECT lpad(c_custkey::VARCHAR, """ + str(tb.UNIT_WIDTH) + """, '0') AS "FIPS", c_acctbal FROM customer) USING ("FIPS")),
cells AS (UNPIVOT (SELECT "FIPS", "State", "Name", "Attribute", "Value", "Balance", NULL::VARCHAR AS "Nothing" FROM b)
          ON "FIPS", "State", "Name", "Attribute", "Value", "Balance" INTO NAME column_name VALUE v)
SELECT column_name,
       CASE WHEN count(try_cast(v AS INTEGER)) FILTER (regexp_matches(v, '^[+-]?[0-9]+$')) = count(v) THEN 'int'
            WHEN count(try_cast(v AS BIGINT)) FILTER (regexp_matches(v, '^[+-]?[0-9]+$')) = count(v) THEN 'bigint'
            WHEN count(try_cast(v AS DOUBLE)) = count(v) THEN 'double' ELSE 'string' END AS data_type,
       count(v) AS cells
FROM cells GROUP BY column_name
UNION ALL SELECT 'Nothing', 'string', 0""")
def q_inferred_types(spark, d):
    """The unit attributes as a typed export would land them, read with the
    types their cells agree on (S3): the inferred type of each column and the
    number of its cells."""
    long = tb.unit_attributes_long(spark, d)
    balance = tb.read(spark, d, "customer").select(tb.pad_code("c_custkey", tb.UNIT_WIDTH).alias("k"), F.col("c_acctbal").cast("string").alias("b"))
    path = _landing(spark, "inferred_csv")
    rows = long.join(balance, long[tb.UNIT] == balance["k"])
    fs.write_csv(rows.select(F.col(tb.UNIT).alias("FIPS"), F.col("state").alias("State"), F.col("unit_name").alias("Name"),
                             F.col("attribute").alias("Attribute"), F.col("value").alias("Value"), F.col("b").alias("Balance"),
                             F.lit(None).cast("string").alias("Nothing")), path)
    typed = fs.read_csv_inferred(spark, path)
    counts = typed.agg(*[F.count(c).alias(c) for c in typed.columns])
    told = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f.name).alias("cells"))
                     for f in typed.schema])
    return counts.select(F.inline(told))


@register("stage_table_roundtrip", O.with_ctes("panel") + """
SELECT period, count(*) AS rows, sum(measure) AS measure,
       'entity_id:bigint,unit_code:string,measure:double,period:int' AS described, true AS found FROM panel GROUP BY period""")
def q_stage_table_roundtrip(spark, d):
    """A stage table is created, replaced, found, described, checked and read
    back by name (S8-S12, S15-S17, P3)."""
    path = _landing(spark, "panel_table")
    panel = P.unit_panel(spark, d)
    fs.save_table(panel.limit(0), "panel", path=path)
    fs.save_table(panel, "panel", partition_by=[tb.PERIOD], path=path)
    name = f"panel_{uuid.uuid4().hex}"
    cat.register(spark.read.parquet(path), name)
    cat.require_tables(spark, [name])
    table = spark.table(cat.first_table(spark, ["no_such_panel", name]))
    if cat.is_empty(table):
        return spark.createDataFrame([], "period int, rows bigint, measure double, described string, found boolean")
    described = ",".join(f"{r['column_name']}:{r['data_type']}" for r in cat.describe_columns(table).orderBy("ordinal_position").collect())
    return table.groupBy(tb.PERIOD).agg(F.count(F.lit(1)).alias("rows"), F.sum("measure").alias("measure")).withColumns({
        "described": F.lit(described), "found": F.lit(cat.table_exists(spark, name))})


@register("bucketed_rating_base", O.with_ctes("rating_base") + """
SELECT entity_id, period, rating, rate_exposure FROM rating_base""", ["rating", "rate_exposure"])
def q_bucketed_rating_base(spark, d):
    """Ratings and exposures as bucketed and sorted stage tables in a namespace
    of their own, joined without an exchange (S7, S9, S10, S12, J4)."""
    space = f"panelscope_{uuid.uuid4().hex}"
    fs.create_namespace(spark, space, _landing(spark, "namespace"))
    counts = P.staged_counts(spark, d)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, df in (("ratings", P.ratings(spark, d, counts)), ("exposures", P.rate_exposure(spark, d, counts))):
        fs.save_table(df, f"{space}.{name}", buckets=buckets, bucket_by=P.KEYS)
    joined = th.rating_base(spark.table(f"{space}.ratings"), spark.table(f"{space}.exposures"), P.KEYS)
    return joined.select(*P.KEYS, "rating", "rate_exposure")
