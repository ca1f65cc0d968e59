import math

import pytest
from pyspark.sql import functions as F

from lotwise.operators import categories as C, quality as Q
from lotwise.operators.features import FEATURES, FeatureBuilder, FeatureStats

# year, mileage, cc, hp, torque -> expected values of known cars, as of 2025
GOLD = [
    ((2016, 109000, 2000, 211, 350), (9, 11.599112335481124, 7.601402334583733, 5.356586274672012, 5.860786223465865, 12111.10976543225, 0.10549999994725, 54.49999997275)),
    ((2003, 198000, 2000, 200, 300), (22, 12.19602736016897, 7.601402334583733, 5.303304908059076, 5.707110264748875, 8999.999590909109, 0.09999999994999999, 98.9999999505)),
    ((2015, 136000, 2000, 240, 320), (10, 11.820417517632333, 7.601402334583733, 5.484796933490655, 5.771441123130016, 13599.998640000136, 0.11999999993999999, 67.99999996599999)),
    ((2018, 48000, 3000, 258, 600), (7, 10.778977123006351, 8.006700845440367, 5.556828061699537, 6.398594934535208, 6857.14187755116, 0.08599999997133334, 15.999999994666668)),
]


def test_known_rows(spark):
    rows = [(i, *map(str, g[0])) for i, g in enumerate(GOLD)]
    df = spark.createDataFrame(rows, "listing_id int, year_of_manufacture string, mileage string, engine_size_cc string, horse_power string, torque string")
    out = FeatureBuilder(2025).fit(df).transform(df).orderBy("listing_id").collect()
    names = ["car_age", "mileage_log", "engine_size_cc_log", "horse_power_log", "torque_log", "mileage_per_year", "power_per_cc", "mileage_per_cc"]
    for row, (_, want) in zip(out, GOLD):
        assert [row[n] for n in names] == pytest.approx(list(want), rel=1e-12)
        assert row["car_age_squared"] == row["car_age"] ** 2


def test_full_table(raw):
    stats = FeatureBuilder(2025).fit(raw)
    out = stats.transform(raw)
    assert out.columns == ["listing_id", "price_log", *FEATURES]
    assert out.count() == raw.count() == stats.rows
    filled = [c for c in out.columns if c != "annual_insurance"]
    assert out.where(" or ".join(f"{c} is null" for c in filled)).count() == 0


def test_stats_round_trip(spark, raw, tmp_path):
    stats = FeatureBuilder(2025).fit(raw)
    stats.save(spark, str(tmp_path / "s"))
    again = FeatureStats.load(spark, str(tmp_path / "s"))
    assert again == stats
    a, b = stats.transform(raw), again.transform(raw)
    assert a.exceptAll(b).count() == 0


def test_year_rules(spark):
    rows = [(1, "0"), (2, "n/a"), (3, "1900"), (4, "2031"), (5, "2010"), (6, "2011")]
    df = spark.createDataFrame(rows, "listing_id int, year_of_manufacture string")
    got = {r["listing_id"]: r["car_age"] for r in FeatureBuilder(2025).fit(df).transform(df).collect()}
    # valid years 2010, 2011, 2031: median 2011; old years stay; future years have age 0
    assert got == {1: 14, 2: 14, 3: 125, 4: 0, 5: 15, 6: 14}
    none = spark.createDataFrame([(1, "0")], "listing_id int, year_of_manufacture string")
    assert FeatureBuilder(2025).fit(none).transform(none).first()["car_age"] == 10


def test_half_even_year(spark):
    df = spark.createDataFrame([(1, "2010"), (2, "2011"), (3, None)], "listing_id int, year_of_manufacture string")
    got = {r["listing_id"]: r["car_age"] for r in FeatureBuilder(2025).fit(df).transform(df).collect()}
    assert got[3] == 15  # 2010.5 rounds to 2010


def test_currency(spark):
    rows = [(1, 10000.0, " USD"), (2, 10000.0, "ksh"), (3, 10000.0, None), (4, 10000.0, "EUR")]
    df = spark.createDataFrame(rows, "listing_id int, price double, currency_code string")
    got = {r["listing_id"]: math.expm1(r["price_log"]) for r in FeatureBuilder(2025).fit(df).transform(df).collect()}
    assert got[1] == pytest.approx(1511134.30) and got[2] == got[3] == got[4] == pytest.approx(10000.0)
    assert [(r["value"], r["rows"]) for r in Q.unmapped_currencies(df).collect()] == [("eur", 1)]


def test_recode_totals(spark):
    condition = {"Foreign Used": 9877, "Excellent": 1423, "Very Good": 1299, "4.5": 546, "Locally Used": 59, "Average": 55, "5": 46,
                 "Ready For Import": 13, "6": 8, "Below Average": 2, "New": 2, "4": 1, "5, 4.5": 1}
    usage = {"Foreign Used": 11700, "Kenyan Used": 1072, "Used": 181, "Locally Used": 59, "Brand New": 34, "Ready For Import": 13, "New": 2, None: 406}

    def totals(values, column, recode):
        df = C.clean_categories(spark.createDataFrame(list(values.items()), f"{column} string, n long"), [column])
        return {r[0]: r[1] for r in df.groupBy(recode(F.col(column))).agg(F.sum("n")).collect()}

    assert totals(condition, "condition", C.condition_clean) == {"Accident free": 13274, "Accident involved": 58}
    assert totals(usage, "usage_type", C.usage_clean) == {"Foreign Used": 11749, "Kenyan Used": 1312 + 406}


def test_rare_thresholds():
    assert [C.rare_threshold(n, 10, 0.001) for n in (1500, 13467, 15000)] == [10, 13, 15]
    assert [C.rare_threshold(n, 5, 0.0005) for n in (1500, 13467, 15000)] == [5, 6, 7]


def test_rare_grouping_inclusive(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [(None,)], "v string")
    assert sorted(r[0] for r in C.kept_values(df, "v", 3).collect()) == ["a", "b"]
    assert [r[0] for r in C.kept_values(df, "v", 3, inclusive=True).collect()] == ["a"]
    out = C.group_rare(df, "v", C.kept_values(df, "v", 4), "rest", "w").groupBy("w").count().collect()
    assert {r["w"]: r["count"] for r in out} == {"a": 5, "rest": 3, None: 1}
    out = C.group_rare(df, "v", ["a"], "rest", "w").groupBy("w").count().collect()
    assert {r["w"]: r["count"] for r in out} == {"a": 5, "rest": 3, None: 1}


def test_rules_on_odd_input(spark):
    nulls = spark.createDataFrame([(None, "1800"), (None, "0")], "price double, year_of_manufacture string")
    got = {r["rule"]: r["status"] for r in Q.rule_report(nulls, 2025).collect()}
    assert got["price_positive"] == "skipped" and got["year_min"] == "failed" and got["year_old_count"] == "warning" and got["overall"] == "failed"
    text = spark.createDataFrame([("12 apples",)], "price string")
    got = {r["rule"]: r["status"] for r in Q.rule_report(text, 2025).collect()}
    assert got["price_numeric"] == "failed" and got["year_exists"] == "warning"
    good = spark.createDataFrame([(5.0, 2000)], "price double, year_of_manufacture int")
    assert {r["rule"]: r["status"] for r in Q.rule_report(good, 2025).collect()}["overall"] == "passed"
    absent = {r["column_name"]: r["status"] for r in Q.missing_share(good).collect()}
    assert absent["make_name"] == "absent" and absent["price"] == "ok"


def test_repeated_vocabulary_entries_add_no_rows(spark):
    df = spark.createDataFrame([("petrol",), ("x",), (None,)], "fuel_type string")
    table = spark.createDataFrame([("fuel_type", "petrol", "b"), ("fuel_type", "petrol", "a"), ("other", "x", "y")], "column_name string, raw string, canonical string")
    out = C.map_by_table(df, table, ["fuel_type"]).collect()
    assert sorted((r["fuel_type"] or "", r["fuel_type_cleaned"] or "") for r in out) == [("", ""), ("petrol", "a"), ("x", "x")]
