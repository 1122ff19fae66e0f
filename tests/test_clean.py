from pyspark.sql import functions as F

from panelscope.functions import clean as cl


def _one(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_clean_measure_edge_rows(spark):
    vals = [None, "", " ", "*", "abc", " 12 ", "12.9", "1e3", "-5", "1,234", "1d", "inf", "1_000", "-3.9", "1e30"]
    want = [0, 0, 0, 0, 0, 12, 12, 1000, -5, 0, 0, 0, 0, -3, 0]
    assert _one(spark, vals, cl.clean_measure) == want


def test_to_number_guards_spark_only_forms(spark):
    assert _one(spark, ["1d", "2.5", " 7 ", "x"], cl.to_number) == [None, 2.5, 7.0, None]


def test_normalize_code(spark):
    vals = ["1001", "01001", "US-01001", "9901001", None, "", "n/a"]
    assert _one(spark, vals, cl.normalize_code) == ["01001"] * 4 + ["00000"] * 3


def test_pad_and_compose(spark):
    df = spark.createDataFrame([(1, 1, 5)], "a int, s int, c int")
    r = df.select(cl.pad_code("a").alias("p"), cl.compose_code("s", "c").alias("c")).first()
    assert (r.p, r.c) == ("00001", "01005")


def test_strip_removes_all_whitespace_kinds(spark):
    assert _one(spark, ["\t a b \n"], cl.strip_ws) == ["a b"]
    assert _one(spark, [" ab ", "  "], cl.normalize_key) == ["AB", None]


def test_na_tokens_and_predicates(spark):
    assert _one(spark, ["NA", "x", "n/a", "NULL"], cl.na_to_null) == [None, "x", None, None]
    assert _one(spark, ["Geographic HPSA", "geographic", None, "Other"],
                lambda c: cl.contains_ci(c, "Geographic")) == [True, True, False, False]
    assert _one(spark, [None, "Primary Care"], lambda c: cl.equals_or_blank(c, "Primary Care")) == [False, True]


def test_safe_div_and_inf(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (float("inf"), 1.0)], "a double, b double")
    got = [tuple(r) for r in df.select(cl.safe_div("a", "b"), cl.inf_to_null("a")).collect()]
    assert got == [(None, 1.0), (0.5, 1.0), (float("inf"), None)]
