import random

import numpy as np
import pytest

from panelscope.operators import quantiles as qt

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_against_numpy(spark, by):
    rnd = random.Random(3)
    rows = [("hot", 1, float(rnd.randint(0, 50))) for _ in range(3000)]          # many ties, one hot group
    rows += [("tied", 1, 7.0)] * 900 + [("tied", 1, 8.0)] * 9                    # one value in 99 of 100 rows
    rows += [(None, None, rnd.random()) for _ in range(50)]                      # a null group
    rows += [(f"g{j}", j % 2, rnd.random() * 10) for j in range(5) for _ in range(rnd.randint(1, 40))]
    df = spark.createDataFrame(rows + [("hot", 1, None), ("empty", 1, None)], "g string, h int, x double")
    got = {(tuple(r[c] for c in by), r.p_index): r.q for r in qt.exact_quantiles(df, "x", PROBS, by, partitions=7).collect()}
    groups = {}
    for g, h, x in rows:
        groups.setdefault(tuple({"g": g, "h": h}[c] for c in by), []).append(x)
    assert set(got) == {(k, i) for k in groups for i in range(len(PROBS))}
    for k, xs in groups.items():
        for i, p in enumerate(PROBS):
            assert got[k, i] == pytest.approx(np.quantile(xs, p), rel=1e-12)


def test_no_rows(spark):
    assert qt.exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5]).collect() == []
