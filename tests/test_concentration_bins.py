import math
import random

from pyspark.sql import functions as F

from panelscope.operators import bins as bn
from panelscope.operators import concentration as conc


def test_concentration_fixtures(spark):
    rows = [("a", 1, "u1", 1.0)] + [("b", 1, f"u{i}", 0.25) for i in range(4)]
    df = spark.createDataFrame(rows, "entity_id string, period int, unit_code string, weight double")
    got = {r.entity_id: r for r in conc.concentration(df, ["entity_id", "period"]).collect()}
    a, b = got["a"], got["b"]
    assert (a.hhi, a.entropy, a.top1_share, a.top5_share, a.n_units) == (1.0, 0.0, 1.0, 1.0, 1)
    assert math.isclose(b.hhi, 0.25) and math.isclose(b.entropy, math.log(4))
    assert math.isclose(b.top1_share, 0.25) and math.isclose(b.top5_share, 1.0)


def test_salted_top_k_matches_brute_force_with_hot_key(spark):
    rnd = random.Random(7)
    rows = [("hot", f"u{i}", rnd.random()) for i in range(3000)]       # one key holds most rows
    rows += [(f"k{j}", f"u{i}", rnd.random()) for j in range(20) for i in range(rnd.randint(1, 12))]
    df = spark.createDataFrame(rows, "k string, u string, v double")
    got = {r.k: r.top for r in conc.top_k_sum(df, ["k"], "v", "u", k=5, salt_buckets=8, out="top").collect()}
    want = {}
    for k, _, v in rows:
        want.setdefault(k, []).append(v)
    for k, vs in want.items():
        assert math.isclose(got[k], sum(sorted(vs, reverse=True)[:5]), rel_tol=1e-12)


def test_quantile_bins_tie_collapse(spark):
    vals = [0, 0, 0, 1, 2, 3, 4, 5, 6, 7, 8]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, x double")
    got = [r.decile for r in bn.quantile_bins(df, "x").orderBy("i").collect()]
    assert got == [1, 1, 1, 1, 2, 3, 4, 5, 6, 7, 8]


def test_bins_invariants(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 37).cast("double").alias("x"))
    b = bn.quantile_bins(df, "x")
    assert b.count() == 1000
    per = b.groupBy("x").agg(F.countDistinct("decile").alias("k")).agg(F.max("k")).first()[0]
    assert per == 1                                   # equal values share a bin
    edges = b.groupBy("decile").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("decile").collect()
    assert all(edges[i].hi < edges[i + 1].lo for i in range(len(edges) - 1))   # monotone
    assert edges[0].lo == 0.0
