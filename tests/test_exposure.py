import math

import pytest
from pyspark.sql import functions as F

from panelscope.operators import exposure as ex
from panelscope.operators import weights as wt


@pytest.fixture
def weights(spark):
    rows = [("E", 1, "u1", 50), ("E", 1, "u2", 30), ("E", 1, "u3", 20), ("E", 1, "u4", 0), ("E", 1, "u5", None)]
    panel = spark.createDataFrame(rows, "entity_id string, period int, unit_code string, measure bigint")
    return wt.share_weights(panel, ["entity_id", "period"])


def _exp(spark, weights, values, missing="renormalize"):
    vals = spark.createDataFrame(values, "unit_code string, v double")
    j = ex.attach_unit_values(weights, vals, ["v"], period=None)
    return j, ex.exposure(j, ["entity_id", "period"], "v", "x", missing=missing).first()


def test_weights_sum_to_one_and_drop_nonpositive(weights):
    rows = weights.collect()
    assert len(rows) == 3
    assert math.isclose(sum(r.weight for r in rows), 1.0)
    assert {r.total_measure for r in rows} == {100}


def test_exposure_table_from_fixtures(spark, weights):
    _, r = _exp(spark, weights, [("u1", 10.0), ("u2", 20.0), ("u3", 30.0)])
    assert math.isclose(r.x, 17.0) and math.isclose(r.coverage_weight_share, 1.0) and r.out_of_scope == 0
    _, r = _exp(spark, weights, [("u1", 10.0), ("u2", 20.0)])
    assert math.isclose(r.x, 13.75) and math.isclose(r.coverage_weight_share, 0.8)
    j, r = _exp(spark, weights, [("u1", 10.0), ("u2", 20.0), ("u3", None)])
    assert math.isclose(r.x, 13.75) and math.isclose(r.coverage_weight_share, 0.8)
    # a null value is not an absent row
    ms = ex.missing_share(j, ["entity_id", "period"]).first()
    assert ms.missing_share == 0.0 and ms.matched_rows == 3
    j, r = _exp(spark, weights, [("zz", 1.0)])
    assert r.x is None and r.out_of_scope == 1 and r.coverage_weight_share == 0.0
    assert ex.fully_unmatched(j, ["entity_id", "period"]).count() == 1


def test_zero_filled(spark, weights):
    _, r = _exp(spark, weights, [("u1", 10.0), ("u2", 20.0)], missing="zero")
    assert math.isclose(r.x, 11.0) and math.isclose(r.matched_weight_share, 0.8)
    assert (r.units_total, r.units_matched) == (3, 2)


def test_lag_join(spark):
    panel = spark.createDataFrame([("E", 2001, "u", 5)], "entity_id string, period int, unit_code string, measure bigint")
    w = wt.share_weights(panel, ["entity_id", "period"])
    vals = spark.createDataFrame([(2000, "u", 1.0), (2001, "u", 9.0)], "period int, unit_code string, v double")
    j = ex.attach_unit_values(w, vals, ["v"], lag=1)
    assert j.first().v == 1.0


def test_unit_score_fallback(spark):
    rows = [("a", 10.0, 100.0), ("a", 20.0, 300.0), ("b", 10.0, None), ("b", 20.0, -5.0),
            ("c", 10.0, 0.0), ("c", 20.0, 1.0)]
    df = spark.createDataFrame(rows, "unit_code string, s double, pop double")
    got = {r.unit_code: (r.unit_score, r.weight_method, r.source_rows)
           for r in ex.unit_score(df, "unit_code", "s", "pop").collect()}
    assert got == {"a": (17.5, "pop_weighted", 2), "b": (15.0, "simple_mean", 2), "c": (20.0, "pop_weighted", 2)}


def test_pivot_attributes(spark):
    rows = [("u1", "S", "n1", "CODE", "3"), ("u1", "S", "n1", "POP", "10"), ("u2", "S", "n2", "CODE", "x")]
    df = spark.createDataFrame(rows, "unit_code string, state string, unit_name string, attribute string, value string")
    wide = ex.pivot_attributes(df, "unit_code", {"code": ("CODE", "int"), "pop": ("POP", "bigint")}, ["state"])
    wide = ex.add_ordinal_flag(wide, "code", "flag")
    got = {r.unit_code: (r.code, r.pop, r.flag) for r in wide.collect()}
    assert got == {"u1": (3, 10, 0), "u2": (None, None, None)}
