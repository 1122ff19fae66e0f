import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from panelscope.sources import catalog as cat
from panelscope.sources import files as fs


@pytest.fixture
def tmp():
    return tempfile.mkdtemp(prefix="panelscope-test-")


def test_banner_csv(spark, tmp):
    for year in (2024, 2025):
        with open(os.path.join(tmp, f"r{year}.csv"), "w") as fh:
            fh.write(f"Report generated {year}, do not edit\n")
            fh.write('Contract Number,"Overall, stars"\n')
            fh.write(f"H1,4.5\nH2,{year}\nH3,Not enough data\n")
    df = fs.read_csv_banner(spark, [os.path.join(tmp, "r2024.csv"), os.path.join(tmp, "r2025.csv")])
    assert df.columns == ["Contract Number", "Overall, stars"]
    assert sorted(tuple(r) for r in df.collect()) == sorted(
        [("H1", "4.5"), ("H2", "2024"), ("H3", "Not enough data")] * 1
        + [("H1", "4.5"), ("H2", "2025"), ("H3", "Not enough data")])


def test_banner_with_blank_lines(spark, tmp_path):
    # the CSV reader leaves out an empty line and reads one of spaces as a record
    for name, banner in (("a", "title\n\n"), ("b", "title\r\n\r\n"), ("c", "title\n  \n"), ("d", "\n\n")):
        end = "\r\n" if name == "b" else "\n"
        (tmp_path / f"{name}.csv").write_bytes((banner + end.join(["K,V", f"{name}1,1", "", f"{name}2,2", ""])).encode())
    rows = sorted(tuple(r) for r in fs.read_csv_banner(spark, str(tmp_path), skip=2).collect())
    assert rows == [(f"{n}{i}", str(i)) for n in "abcd" for i in (1, 2)]


def test_string_csv_na_tokens_and_by_year(spark, tmp):
    p = os.path.join(tmp, "e.csv")
    with open(p, "w") as fh:
        fh.write("Contract ID,FIPS Code,Enrollment\nH1,1001,*\nH1,NA,12\n")
    df = fs.read_csv_strings(spark, p)
    assert [tuple(r) for r in df.collect()] == [("H1", "1001", "*"), ("H1", None, "12")]
    both = fs.read_by_year({2024: df, 2025: df})
    assert both.groupBy("year").count().count() == 2


def test_latin1_and_typed(spark, tmp):
    p = os.path.join(tmp, "l.csv")
    with open(p, "wb") as fh:
        fh.write("FIPS,County_Name,Value\n1001,Do\xf1a Ana,4\n".encode("latin-1"))
    s = fs.read_csv_latin1(spark, p).first()
    assert s.County_Name == "Doña Ana"
    schema = StructType([StructField("FIPS", IntegerType()), StructField("County_Name", StringType()),
                         StructField("Value", IntegerType())])
    t = fs.read_csv_typed(spark, p, schema, pad={"FIPS": 5}, encoding="ISO-8859-1").first()
    assert (t.FIPS, t.Value) == ("01001", 4)


def test_json_header_rows(spark, tmp):
    payload = [["NAME", "SAEPOVRTALL_PT", "state", "county"], ["A County", "12.5", "1", "1"], ["B", "x", "2", "13"]]
    p = os.path.join(tmp, "pov_2023.json")
    with open(p, "w") as fh:
        json.dump(payload, fh)
    df = fs.read_header_rows_json(spark, p)
    assert df.columns == ["NAME", "SAEPOVRTALL_PT", "state", "county"]
    assert [tuple(r) for r in df.collect()] == [("A County", "12.5", "1", "1"), ("B", "x", "2", "13")]


def test_sinks_roundtrip(spark, tmp):
    df = spark.range(0, 5).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("b"))
    out = os.path.join(tmp, "csv")
    fs.write_csv(df, out, single_file=True)
    assert sorted(r.a for r in fs.read_csv_strings(spark, out).collect()) == ["0", "1", "2", "3", "4"]
    fs.save_table(df, "t", partition_by=["a"], path=os.path.join(tmp, "pq"))
    assert spark.read.parquet(os.path.join(tmp, "pq")).count() == 5


def test_catalog_checks(spark):
    df = spark.range(3).withColumn("stars", F.lit(1.0))
    cat.require_columns(df, ["id"])
    with pytest.raises(cat.MissingColumns):
        cat.require_columns(df, ["nope"])
    assert cat.pick_column(df, ["star_rating", "stars"]) == "stars"
    cat.register(df, "tmp_tbl")
    assert cat.table_exists(spark, "TMP_TBL") and cat.first_table(spark, ["nope", "tmp_tbl"]) == "tmp_tbl"
    assert [r.column_name for r in cat.describe_columns(df).collect()] == ["id", "stars"]
    assert cat.is_empty(df.filter("id < 0"))
    obs_df, obs = cat.counted(df, "n")
    obs_df.collect()
    assert obs.get["rows"] == 3
    c = cat.completeness(df.withColumn("v", F.when(F.col("id") > 0, 1)), "v").first()
    assert (c.total, c.non_null, c.null_count) == (3, 2, 1)


def _land(folder, many):
    folder.mkdir()
    for i in range(many):
        names = ["K", "V", "extra"] if i % 3 == 0 else ["V", "K"]
        row = [f"k{i}", f"v{i}", 'a "quoted"\ncell'] if i % 3 == 0 else [f"v{i}", f"k{i}"]
        quoted = ",".join('"' + c.replace('"', '""') + '"' for c in row)
        (folder / f"p={2000 + i}.csv").write_text(f"banner, {i}\n{','.join(names)}\n{quoted}\n")
    return str(folder)


def test_many_files_are_one_scan(spark, tmp_path):
    few, many = _land(tmp_path / "few", 3), _land(tmp_path / "many", 400)
    plans = []
    for path, n in ((few, 3), (many, 400)):
        df = fs.read_csv_banner(spark, path, file_column="file").withColumn("p", fs.period_of_file("file", r"p=([0-9]+)\.csv"))
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        assert df.columns == ["K", "V", "extra", "file", "p"]
        rows = {r["K"]: r for r in df.collect()}
        assert len(rows) == n and all(r["V"] == "v" + k[1:] and r["p"] == 2000 + int(k[1:]) for k, r in rows.items())
        assert rows["k0"]["extra"] == 'a "quoted"\ncell' and rows["k1"]["extra"] is None
    assert plans[0].count("Scan") == plans[1].count("Scan") == 1 and "Union" not in plans[1]
    assert len(plans[0].splitlines()) == len(plans[1].splitlines())


def test_files_without_header_and_odd_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("banner\nA|B|A\n1||3\n4\n5|6|7|8\n")
    rows = fs.read_csv_banner(spark, str(tmp_path), sep="|").collect()
    assert [tuple(r) for r in rows] == [("1", None), ("4", None), ("5", "6")]
    (tmp_path / "b.csv").write_text("banner\n")
    with pytest.raises(ValueError, match="b.csv"):
        fs.read_csv_banner(spark, str(tmp_path))


def test_inferred_types(spark, tmp_path):
    rows = [("1", "1", "1", "1.5", "x", ""), ("-2", "3000000000", "99999999999999999999", " 2e3 ", "1", "NA"), ("", "5", "7", "NaN?", "2", "")]
    (tmp_path / "t.csv").write_text("a,b,c,d,e,f\n" + "".join(",".join(r) + "\n" for r in rows[:2]))
    df = fs.read_csv_inferred(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "bigint", "double", "double", "string", "string"]
    assert [tuple(r) for r in df.collect()] == [(1, 1, 1.0, 1.5, "x", None), (-2, 3000000000, 1e20, 2000.0, "1", None)]
    assert dict(fs.infer_types(df.limit(0).select(F.lit("x").alias("g"))))["g"] == "string"


def test_bucketed_tables_join_without_exchange(spark):
    import __spark_entry__ as E
    from conftest import SF001

    df = E.queries()["bucketed_rating_base"](spark, SF001)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = df.select("*")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
