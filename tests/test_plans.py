"""Plan guards: no cartesian or nested-loop join, pruned scans."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF001

QUERIES = ["share_weights", "model_frame", "band_difference", "concentration", "share_percentiles",
           "decile_effect_rate", "summary_stats", "sample_entity_weights", "bootstrap_diff"]


@pytest.mark.parametrize("name", QUERIES)
def test_no_cartesian_and_pruned_scans(spark, name):
    df = E.queries()[name](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for schema in re.findall(r"ReadSchema: struct<([^>\n]*)", plan):
        assert schema.count(":") <= 6, schema       # no scan reads whole wide tables
