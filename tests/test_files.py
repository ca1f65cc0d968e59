import pytest

from lotwise.sources import files as S, scratch


def test_read_listings(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("Make Name,Unnamed: 0,Price-(KES)\nToyota,1,N/A\nnan,2, 5 \n")
    df = S.read_listings(spark, str(p))
    assert df.columns == ["make_name", "unnamed:_0", "price_kes"]
    assert [tuple(r) for r in df.collect()] == [("Toyota", "1", None), (None, "2", " 5 ")]
    assert S.read_listings(spark, str(tmp_path / "none.csv"), missing_ok=True) is None
    with pytest.raises(Exception):
        S.read_listings(spark, str(tmp_path / "none.csv"))


def test_quoted_values(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/1.csv").write_text('make,detail,price\nToyota,"said ""clean, one owner"" ok",100\nMazda,"two\nlines",7\n')
    (tmp_path / "a/2.csv").write_text("make,detail,price\nKia,,5\n")
    rows = {tuple(r) for r in S.read_listings(spark, str(tmp_path / "a")).collect()}
    assert rows == {("Toyota", 'said "clean, one owner" ok', "100"), ("Mazda", "two\nlines", "7"), ("Kia", None, "5")}
    (tmp_path / "a/3.csv").write_text("make,price,detail\nKia,5,x\n")
    with pytest.raises(Exception):
        S.read_listings(spark, str(tmp_path / "a")).collect()


def test_nan_becomes_null_and_names_must_differ(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "b")], "x double, y string")
    assert S.normalize_missing(df).where("x is null").count() == 1
    with pytest.raises(ValueError):
        S.clean_column_names(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "stage")
    S.write_stage(spark.range(3), path, "20250101_000000")
    S.write_stage(spark.range(5), path, "20250520_123812")
    S.write_stage(spark.range(4), path, "20250301_000000")
    latest = S.read_latest(spark, path)
    assert {f.split("run_ts=")[1][:15] for f in latest.inputFiles()} == {"20250520_123812"}
    assert latest.count() == 5 and latest.columns == ["id"]
    S.write_stage(spark.range(6), path, "20250520_123812")  # same stamp again replaces
    assert S.read_latest(spark, path).count() == 6


def test_names_and_counts(spark, tmp_path):
    S.write_names(spark, ["b", " ", "a"], str(tmp_path / "n"))
    assert S.read_names(spark, str(tmp_path / "n")) == ["b", "a"]
    df = spark.createDataFrame([("x",), ("y",), ("x",)], "v string")
    S.write_value_counts(df, "v", str(tmp_path / "c"))
    back = spark.read.option("header", True).csv(str(tmp_path / "c")).collect()
    assert [(r["v"], r["count"]) for r in back] == [("x", "2"), ("y", "1")]


def test_union_tags_rows(spark):
    out = S.union_sources({"one": spark.range(2), "two": spark.createDataFrame([(7, "z")], "id long, extra string")})
    assert {(r["id"], r["extra"], r["source_dataset"]) for r in out.collect()} == {(0, None, "one"), (1, None, "one"), (7, "z", "two")}


def test_materialize_cuts_lineage(spark):
    df = scratch.materialize(spark.range(10).selectExpr("id * 2 as x"), "test")
    assert "Project" not in df._jdf.queryExecution().logical().toString() and df.count() == 10
