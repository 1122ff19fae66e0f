"""One test for each fault found in review."""

import json

import pytest
from pyspark.sql import functions as F

from panelscope.functions import clean as cl
from panelscope.operators import joins, report, weights
from panelscope.session import ensure_checkpoint_dir
from panelscope.sources import files as fs


def test_banner_files_have_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('banner\nK,V\nx,"1\n2"\nK,V\ny,3\n')
    (tmp_path / "b.csv").write_text('banner, with "comma\nV,K,extra\n4,z,e\n')
    rows = {(r["K"], r["V"], r["extra"]) for r in fs.read_csv_banner(spark, str(tmp_path)).collect()}
    # the row that repeats the header inside the first file is data
    assert rows == {("x", "1\n2", None), ("K", "V", None), ("y", "3", None), ("z", "4", "e")}


def test_json_documents_have_their_own_headers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([["A", "B"], ["a1", "b1"]]))
    (tmp_path / "b.json").write_text(json.dumps([["B", "A"], ["b2", "a2"], ["b3", None]]))
    rows = {(r["A"], r["B"]) for r in fs.read_header_rows_json(spark, str(tmp_path)).collect()}
    assert rows == {("a1", "b1"), ("a2", "b2"), (None, "b3")}


def test_strip_and_missing_tokens(spark):
    texts = ["  a  ", "\x1cb\x1f", " ", "#NA", "1.#IND", "-1.#QNAN", "#N/A N/A", "ok"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(cl.strip_ws("t")).collect()] == [t.strip() for t in texts]
    assert [r[0] for r in df.select(cl.na_to_null("t")).collect()][3:] == [None, None, None, None, "ok"]


def test_fractional_measures_stay_whole(spark):
    rows = spark.createDataFrame([("e", "u", 1.6), ("e", "v", 0.8), ("e", "v", 1.0)], "e string, u string, m double")
    panel = weights.aggregate_panel(rows, ["e", "u"], "m")
    assert sorted(r["measure"] for r in panel.collect()) == pytest.approx([1.6, 1.8])
    shares = weights.share_weights(panel, ["e"]).collect()
    assert sum(r["weight"] for r in shares) == pytest.approx(1.0)


def test_hash_table_is_built_on_the_small_side(spark):
    big = spark.range(2000).select(F.col("id").alias("k"), F.explode(F.sequence(F.lit(1), F.lit(50))).alias("n"))
    small = spark.range(2000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    df = joins.join_building_on(big, small, ["k"])
    assert df.count() == 100_000
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BuildRight" in plan and "BuildLeft" not in plan


def test_box_leaves_out_the_lowest_band(spark):
    df = spark.createDataFrame([(2.5, 0.0), (3.0, 0.1), (3.5, 0.2), (4.5, 0.3)], "rating double, residual double")
    assert {r["report_band"] for r in report.residual_box(df).collect()} == {"3.0-3.4", "3.5-3.9", "4.0+"}


def test_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_reports_are_sorted(spark):
    import __spark_entry__ as E
    from conftest import SF001

    export = [(r["entity_id"], r["period"]) for r in E.queries()["full_export"](spark, SF001).collect()]
    series = [(r["period"], r["decile"]) for r in E.queries()["gradient_series"](spark, SF001).collect()]
    assert export == sorted(export) and series == sorted(series)
