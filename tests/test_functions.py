import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotwise.functions import numbers as N, text as X

PROBES = [" 12 ", "1e3", "inf", "NaN", "12d", "1,200", "", "  ", "-4.5", "+7", ".5", "5.", "0x1p3", "abc", "1e999", "Infinity", "1_0"]


def one(spark, column, value, expr):
    df = spark.createDataFrame([(value,)], f"{column} string")
    return df.select(expr).first()[0]


def test_numbers_are_read_as_pandas_does(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(PROBES)], "i int, v string")
    got = {r["i"]: r["n"] for r in df.select("i", N.to_number(F.col("v")).alias("n")).collect()}
    want = pd.to_numeric(pd.Series(PROBES), errors="coerce")
    for i, w in want.items():
        if pd.isna(w) or w in (float("inf"), float("-inf")):
            assert got[i] is None, PROBES[i]
        else:
            assert got[i] == w, PROBES[i]


@pytest.mark.parametrize("raw", ["  a b\t", "\n x　", "plain", "", " \x0b "])
def test_strip_is_python_strip(spark, raw):
    assert one(spark, "v", raw, X.strip(F.col("v"))) == raw.strip()


def test_placeholders_and_fill(spark):
    df = spark.createDataFrame([(" N/A ",), ("Other",), (None,), (" Toyota ",)], "v string")
    assert [r[0] for r in df.select(X.clean_category(F.col("v"))).collect()] == ["unknown", "unknown", "unknown", "toyota"]
    assert [r[0] for r in df.select(X.clean_category(F.col("v"), None)).collect()] == [None, None, None, "toyota"]


def test_money_round_trip(spark):
    df = spark.createDataFrame([(1234567.5,), (2.5,), (None,)], "v double")
    text = df.select(X.money(F.col("v")).alias("t"))
    assert [r[0] for r in text.collect()] == ["KES 1,234,568", "KES 2", "N/A"]
    assert [r[0] for r in text.select(X.parse_money(F.col("t"))).collect()] == [1234568.0, 2.0, None]


def test_column_names():
    assert X.clean_name(" Engine Size-CC (raw) ") == "engine_size_cc_raw"


def test_ratios(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (None, 4.0)], "a double, b double")
    rows = df.select(N.exact_ratio(F.col("a"), F.col("b")), N.ratio(F.col("a"), F.col("b")), N.per_year(F.col("a"), F.col("b"))).collect()
    assert rows[0][0] == 0.0 and rows[0][1] == pytest.approx(1e7) and rows[0][2] == 10.0
    assert rows[1][0] == 2.5 and rows[1][1] == 10.0 / (4.0 + 1e-6)
    assert rows[2][0] is None and rows[2][1] is None


def test_inverse_of_the_target(spark):
    row = spark.range(1).select(N.invert_log(F.log1p(F.lit(100.0))), N.invert_log(F.log1p(F.lit(100.0)), "exp")).first()
    assert row[0] == pytest.approx(100.0) and row[1] == pytest.approx(101.0)
