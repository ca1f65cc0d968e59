import datetime as dt

import pytest
from pyspark.sql import functions as F

from lotwise.operators import requests as Q
from lotwise.operators.features import FEATURES
from lotwise.streaming import monitor as W, scoring as C
from lotwise.streaming.runner import run_to_files


def good_request(**changes):
    base = {f.name: {"string": " x ", "double": 1.0, "int": 1}[f.kind] for f in Q.CONTRACT}
    return {**base, **changes}


def frame(spark, rows):
    schema = ", ".join(f"{f.name} {f.kind}" for f in Q.CONTRACT)
    return spark.createDataFrame([tuple(r[f.name] for f in Q.CONTRACT) for r in rows], schema)


def test_contract(spark):
    rows = [good_request(), good_request(mileage_num=None), good_request(seats_num=21.0, is_luxury_make=2), good_request(car_age=-1.0)]
    out = [r["violations"] for r in Q.validate(frame(spark, rows)).collect()]
    assert out == [[], ["mileage_num: required"], ["seats_num: above 20", "is_luxury_make: above 1"], ["car_age: below 0"]]
    assert Q.validate(frame(spark, rows)).first()["make_name_cleaned"] == "x"
    assert "fuel_type_cleaned: required" in Q.validate(frame(spark, rows).drop("fuel_type_cleaned")).first()["violations"]
    valid, bad = Q.split_valid(Q.validate(frame(spark, rows)))
    assert valid.count() == 1 and bad.count() == 3


def test_defaults_and_refresh(spark):
    row = Q.preprocess(frame(spark, [good_request(horse_power_num=None, horse_power_log=None, engine_size_cc_num=0.0)])).first()
    assert row["filled"] == ["horse_power_num"] and row["horse_power_num"] == 100.0
    assert row["horse_power_log"] == pytest.approx(4.61512051684126) and row["power_per_cc"] == 0.0
    row = Q.preprocess(frame(spark, [good_request()]).drop("torque_num", "torque_log")).first()
    assert row["filled"] == ["torque_num"] and row["torque_num"] == 150.0


def test_input_forms():
    assert Q.missing_inputs(FEATURES) == [] and Q.missing_inputs([f for f in FEATURES if f != "annual_insurance"]) == []
    assert Q.missing_inputs([f for f in FEATURES if f != "car_age"]) == ["car_age"]
    assert Q.is_encoded(["num_main__car_age"]) and "num_main__seats_num" in Q.missing_inputs(["num_main__car_age"])


def test_order(spark):
    df = frame(spark, [good_request()]).withColumn("listing_id", F.lit(1))
    assert Q.ordered(df, ["listing_id"]).columns == ["listing_id", *FEATURES]
    with pytest.raises(ValueError, match="car_age"):
        Q.ordered(df.drop("car_age"), [])


def times(spark, rows, path, name):
    spark.createDataFrame([(i, dt.datetime(2025, 1, d, h), float(v)) for i, d, h, v in rows], "id int, ts timestamp, value double") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def source(spark, path):
    return spark.readStream.schema("id int, ts timestamp, value double").parquet(f"{path}/*")


def test_monitor_drops_late_rows_and_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    times(spark, [(1, 1, 1, 5), (2, 1, 2, 500), (3, 2, 1, 7)], src, "a")
    stream = W.monitor(source(spark, src), "ts", "value", 0, 100)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    run_to_files(stream, "m", out, checkpoint=cp)
    times(spark, [(4, 9, 1, 1)], src, "b")
    run_to_files(W.monitor(source(spark, src), "ts", "value", 0, 100), "m", out, checkpoint=cp)
    times(spark, [(5, 1, 3, 9), (6, 20, 1, 1)], src, "c")  # row 5 is late by a week
    run_to_files(W.monitor(source(spark, src), "ts", "value", 0, 100), "m", out, checkpoint=cp)
    got = {r["window_start"].day: (r["rows"], r["mean"], r["outside_share"]) for r in spark.read.parquet(out).collect()}
    assert got == {1: (2, 252.5, 0.5), 2: (1, 7.0, 0.0), 9: (1, 1.0, 0.0)}


def test_replays_pass_once_across_batches(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for name in ("a", "b"):
        times(spark, [(1, 1, 1, 5), (2, 1, 2, 6)], src, name)
        run_to_files(W.replays_dropped(source(spark, src), ["id"], "ts"), "r", out, checkpoint=cp)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_drift_is_zero_without_change(spark, tmp_path):
    rows = [(i, d, 1, i % 5 * 10) for d in (1, 2, 5) for i in range(10)]
    src = str(tmp_path / "in")
    times(spark, rows, src, "a")
    edges = [5.0, 15.0, 25.0]
    base = W.profile(spark.read.parquet(f"{src}/*"), "value", edges)
    assert base == [0.2, 0.2, 0.2, 0.4]
    out = run_to_files(W.drift(source(spark, src), "ts", "value", edges, base), "d", str(tmp_path / "out"))
    got = spark.read.parquet(out).collect()
    assert len(got) == 2 and all(abs(r["psi"]) < 1e-12 for r in got)


def test_scoring_stream_writes_each_row_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = frame(spark, [good_request()]).schema
    for i, rows in enumerate([[good_request(), good_request(car_age=-2.0)], [good_request(mileage_num=7.0)]]):
        frame(spark, rows).coalesce(1).write.parquet(f"{src}/{i}")
        stream = spark.readStream.schema(schema).parquet(f"{src}/*")
        C.score_stream(stream, lambda d: d.select("mileage_num", "power_per_cc"), out, checkpoint=cp)
    assert sorted(r["mileage_num"] for r in C.read_scores(spark, out).collect()) == [1.0, 7.0]
    assert C.read_scores(spark, out, "quarantine").count() == 1


def test_updates_show_open_windows_of_several_batches(spark, tmp_path):
    from lotwise.streaming.runner import run_updates

    src = str(tmp_path / "in")
    for name, rows in (("a", [(1, 1, 1, 5), (2, 2, 2, 500)]), ("b", [(3, 2, 3, 7)]), ("c", [(4, 9, 1, 1), (5, 9, 2, 3)])):
        times(spark, rows, src, name)
    stream = spark.readStream.schema(spark.read.parquet(f"{src}/a").schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    got = {r["window_start"].day: (r["rows"], r["mean"]) for r in run_updates(W.monitor(stream, "ts", "value", 0, 100), "m").collect()}
    assert got == {1: (1, 5.0), 2: (2, 253.5), 9: (2, 2.0)}
