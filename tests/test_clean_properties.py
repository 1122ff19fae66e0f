"""Property tests: the Spark cleaning expressions against a plain-Python
statement of the same rules (FIXTURES.md section 3)."""

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelscope.functions import clean as cl

NUM = re.compile(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")


def py_measure(s):
    if s is None:
        return 0
    t = s.strip()
    if not NUM.match(t):
        return 0
    v = float(t)
    return int(v) if math.isfinite(v) and abs(v) < 9.2e18 else 0


def py_code(s):
    d = re.sub(r"[^0-9]", "", s or "")
    return d[-5:].zfill(5)


texts = st.one_of(
    st.none(),
    st.from_regex(r"\s{0,2}[+-]?\d{0,6}(\.\d{0,3})?([eE][+-]?\d{1,2})?\s{0,2}", fullmatch=True),
    st.text(alphabet="0123456789-*.,eE abUS", max_size=12),
)


@settings(max_examples=1, deadline=None)
@given(st.lists(texts, min_size=150, max_size=150))
def test_measure_and_code_rules(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = df.orderBy("i").select(cl.clean_measure("v").alias("m"), cl.normalize_code("v").alias("c")).collect()
    for v, r in zip(values, got):
        assert r.m == py_measure(v), v
        assert r.c == py_code(v), v
