import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events".split()
# a cheap cross-section of the registry; tools/check_oracle.py runs all of it
SPOT = ["share_weights", "lagged_exposure", "static_exposure", "zero_filled_exposure", "band_difference",
        "concentration", "model_frame", "decile_effect_units", "summary_stats", "clean_measure"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["period", "ew_mean_low", "ew_mean_high", "diff_low_minus_high"]
    assert df.count() >= 0


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


def _norm(v):
    return "NULL" if v is None else (repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v))


@pytest.mark.parametrize("name", SPOT)
def test_oracle_match(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = df.columns
    got = sorted("|".join(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == sorted(cols)
    want = sorted("|".join(_norm(dict(zip(ocols, r))[c]) for c in sorted(cols)) for r in cur.fetchall())
    assert got == want
