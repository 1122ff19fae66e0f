"""Order with positions, step counts, packed unit values, sketches, one stage
of the facts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from panelscope.operators import concentration as conc
from panelscope.operators import exposure as ex
from panelscope.operators import quantiles as qt
from panelscope.operators.order import with_position
from panelscope.sources import catalog as cat


def test_positions_are_those_of_a_sort(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice("abc"), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, i int").repartition(6)
    got = with_position(df, F.col("a").desc_nulls_last(), "b", "i", partitions=5).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(1, 501))
    assert with_position(df.limit(0), "i").collect() == []


def test_step_counts_need_no_job_of_their_own(spark):
    steps = cat.StepCounts()
    df = steps.step(spark.range(100), "read")
    df = steps.step(df.filter("id % 4 = 0"), "kept")
    df = steps.step(df.groupBy(F.col("id") % 8).count(), "grouped")
    df.write.format("noop").mode("overwrite").save()
    assert [tuple(r) for r in steps.table(spark).collect()] == [(0, "read", 100, 0), (1, "kept", 25, 75), (2, "grouped", 2, 23)]


@pytest.mark.parametrize("seed", [1, 2])
def test_packed_unit_values_join_as_the_tables_do(spark, seed):
    rng = random.Random(seed)
    w = spark.createDataFrame([(e, p, f"u{rng.randrange(8)}", 1.0) for e in range(5) for p in (1, 2, 3)], "e int, period int, unit_code string, weight double")
    w = w.unionByName(w.limit(1).withColumn("unit_code", F.lit(None).cast("string")))
    rates = spark.createDataFrame([(f"u{u}", p, rng.choice([None, float(p * u)])) for u in range(6) for p in (1, 2) if rng.random() < 0.8],
                                  "unit_code string, period int, rate double")
    codes = spark.createDataFrame([(f"u{u}", rng.choice([None, 0, 1])) for u in (0, 2, 7)] + [(None, 1)], "unit_code string, flag int")
    packed = ex.pack_unit_values(rates, "rate", [(codes, "flag")])
    got = ex.attach_packed(w, packed, "rate", lag=1)
    one = ex.attach_unit_values(w, rates, ["rate"], lag=1).withColumnRenamed(ex.MATCHED, "has_rate")
    want = ex.attach_unit_values(one, codes, ["flag"], period=None).withColumnRenamed(ex.MATCHED, "has_flag")
    cols = ["e", "period", "unit_code", "weight", "rate", "has_rate", "flag", "has_flag"]
    key = lambda r: repr(tuple(r))
    assert sorted(got.select(cols).collect(), key=key) == sorted(want.select(cols).collect(), key=key)


def test_sketch_quantiles_are_within_the_stated_rank_error(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=30000), np.zeros(5000)])
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(x)], "g int, x double").repartition(7)
    sketches = qt.quantile_sketches(df, "x", ["g"])
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for frame, by in ((sketches, ["g"]), (qt.merge_sketches(sketches), [])):
        for r in qt.approximate_quantiles(frame, probs, by).collect():
            v = x[np.arange(len(x)) % 3 == r["g"]] if by else x
            assert (v < r["q"]).mean() <= r["p"] + r["rank_error"] and (v <= r["q"]).mean() >= r["p"] - r["rank_error"]


@pytest.mark.parametrize("name", ["near_threshold_structural", "missing_exposures", "model_frame", "rating_base"])
def test_the_facts_are_staged_once(spark, monkeypatch, name):
    import __spark_entry__ as E
    from panelscope.plans import panel as P

    staged, write = [], P.materialize
    monkeypatch.setattr(P, "materialize", lambda df, name="stage": staged.append(name) or write(df, name))
    out = E.queries()[name](spark, SF001)
    assert staged.count("unit_counts") == 1
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "l_suppkey" not in plan  # nothing reads the line items again


def test_features_join_the_units_once(spark):
    from panelscope.plans import panel as P

    plan = P.model_frame(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(unit_code#") <= 2 and "by_period" in plan


def test_unit_keys_tell_units_apart_as_their_codes_do(spark):
    from panelscope.sources import tables as tb

    big = 10 ** 18
    keys = [None, 0, 1, 10, -1, -10, big - 1, big, 2 ** 63 - 1, 1 - big, -big, -big // 10, -big - 9, -big // 10 - 1, -2 ** 63, -2 ** 63 + 8, -(2 ** 63) // 10]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").select(tb.unit_code("k").alias("c"), tb.unit_key("k").alias("u"))
    rows = df.collect()
    assert all((a.c == b.c) == (a.u == b.u) for a in rows for b in rows)
    assert len({r.u for r in rows}) < len(keys)  # some codes are cut to the same


def test_top_k_floor_keeps_the_top_k(spark):
    rng = random.Random(4)
    rows = [("few", "a", 1.0), ("few", "b", 2.0), ("none", "a", None)]
    rows += [(f"g{g}", f"u{i}", float(rng.randrange(1, 400))) for g in range(12) for i in range(200)]
    rows += [("tied", f"u{i}", 3.0) for i in range(100)]
    df = spark.createDataFrame(rows, "g string, u string, v double").repartition(5)
    floors = {r.g: r.floor for r in df.groupBy("g").agg(conc.top_k_floor(F.col("v"), "u", k=5).alias("floor")).collect()}
    assert floors["few"] is None and floors["none"] is None and floors["tied"] == 3.0
    for g in {r[0] for r in rows if r[0].startswith("g")}:
        values = sorted((v for k, _, v in rows if k == g), reverse=True)
        assert floors[g] <= values[4] and sum(v >= floors[g] for v in values) <= 60


def test_features_move_numbers_and_rank_few_units(spark, monkeypatch):
    """the facts are grouped and joined by a number a unit, an entity-period
    has its sums from one aggregate, and the top share ranks what reaches its floor."""
    from panelscope.plans import panel as P

    staged, write = {}, P.materialize
    monkeypatch.setattr(P, "materialize", lambda df, name="stage": staged.setdefault(name, write(df, name)))
    plan = P.model_frame(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert dict(staged["unit_counts"].dtypes)["unit_code"] == "bigint"
    assert set(staged) == {"unit_counts", "groups"} and "lpad" not in plan
    assert "_floor" in plan
    top = {(r.entity_id, r.period): r.top5_share for r in P.model_frame(spark, SF001).collect()}
    want = {(r.entity_id, r.period): r.top5_share for r in P.concentration(spark, SF001).collect()}
    assert top and all(abs(v - want[k]) < 1e-12 for k, v in top.items())
