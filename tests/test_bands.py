from pyspark.sql import functions as F

from panelscope.functions import bands as b


def test_three_band_definitions(spark):
    df = spark.createDataFrame([(x,) for x in [3.0, 3.5, 3.95, 4.0, 4.5, 5.0, None]], "r double")
    rows = df.select(b.threshold_band("r"), b.threshold_flag("r"), b.report_band("r"), b.near_flag("r")).collect()
    assert [r[0] for r in rows] == ["other", "3.5-3.9", "3.5-3.9", "4.0-4.5", "4.0-4.5", "other", "other"]
    assert [r[1] for r in rows] == [0, 0, 0, 1, 1, 1, 0]
    assert [r[2] for r in rows] == ["3.0-3.4", "3.5-3.9", "<3.0", "4.0+", "4.0+", "4.0+", "<3.0"]
    assert [r[3] for r in rows] == [1, 1, 0, 0, 0, 0, 0]


def test_residual_bucket(spark):
    df = spark.createDataFrame([(x,) for x in [0.25, -0.25, 0.2499, None]], "x double")
    got = [r[0] for r in df.select(b.residual_bucket("x")).collect()]
    assert got == [b.BUCKET_OVER, b.BUCKET_UNDER, b.BUCKET_NEAR, b.BUCKET_NEAR]


def test_ordinal_flag_keeps_null(spark):
    df = spark.createDataFrame([(3,), (4,), (None,)], "c int")
    assert [r[0] for r in df.select(b.ordinal_flag("c")).collect()] == [0, 1, None]


def test_period_label(spark):
    df = spark.createDataFrame([(0,), (1,), (7,)], "p int")
    got = [r[0] for r in df.select(b.period_label("p", {0: "2024", 1: "2025"})).collect()]
    assert got == ["2024", "2025", "Unknown"]
