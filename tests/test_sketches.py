import random

import pytest
from pyspark.sql import functions as F

from lotwise.operators.sketches import DISTINCT_ERROR, RANK_ERROR, errors, merge_sketches, read_sketches, report, save_sketches, sketch_profile


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(1)
    data = [(k % 6, None if k % 50 == 0 else float(int(r.expovariate(0.001))), None if k % 40 == 0 else f"w{min(int(r.paretovariate(0.8)), 5000)}",
             None, float("nan") if k % 7 == 0 else 1.0) for k in range(30_000)]
    return spark.createDataFrame(data, "day int, x double, t string, none double, nan double").repartition(7)


COLUMNS = ["x", "t", "none", "nan"]


def test_merged_runs_are_one_pass(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    for day in range(6):
        save_sketches(sketch_profile(rows.where(F.col("day") == day), COLUMNS, F.col("day")), path)
    save_sketches(sketch_profile(rows.where("day = 3"), COLUMNS, F.col("day")), path)  # a repeated run counts once
    store = read_sketches(spark, path)
    assert store.count() == 24
    merged = {r.column_name: r for r in report(merge_sketches(store)).collect()}
    whole = {r.column_name: r for r in report(merge_sketches(sketch_profile(rows, COLUMNS, F.lit("all")))).collect()}
    for c in COLUMNS:
        for field in ("rows", "nulls", "least", "most"):
            assert merged[c][field] == whole[c][field]
        assert merged[c].distinct_values == pytest.approx(whole[c].distinct_values, rel=DISTINCT_ERROR, abs=1)
    assert merged["none"].nulls == 30_000 and merged["none"].distinct_values == 0 and merged["none"].p50 is None
    assert merged["nan"].nulls == sum(k % 7 == 0 for k in range(30_000)) and merged["nan"].distinct_values == 1


def test_merge_of_merges(rows):
    runs = sketch_profile(rows, COLUMNS, F.col("day")).withColumn("half", F.col("run_ts") < "3")
    halves = merge_sketches(runs, "half").drop("half")
    one, two = (report(merge_sketches(s)).where("column_name = 'x'").first() for s in (runs, halves))
    assert (one.rows, one.nulls, one.distinct_values) == (two.rows, two.nulls, two.distinct_values)


def test_within_the_stated_errors(rows):
    merged = merge_sketches(sketch_profile(rows, COLUMNS, F.col("day")))
    for r in errors(rows, COLUMNS, merged).collect():
        assert r.distinct_within and r.ranks_within in (True, None) and r.rows == 30_000
    got = report(merged).where("column_name = 'x'").first()
    values = sorted(r.x for r in rows.where("x is not null").collect())
    for p, q in ((0.25, got.p25), (0.5, got.p50), (0.75, got.p75)):
        below, upto = sum(v < q for v in values), sum(v <= q for v in values)
        assert below - RANK_ERROR * len(values) <= p * len(values) <= upto + RANK_ERROR * len(values)


def test_frequent_values(rows):
    merged = merge_sketches(sketch_profile(rows, ["t"], F.col("day")))
    top = report(merged, top=3).first().top
    want = rows.where("t is not null").groupBy("t").count().orderBy(F.desc("count"), "t").limit(3).collect()
    assert report(merge_sketches(sketch_profile(rows, ["none"], F.col("day")))).first().top == []
    assert [t.item for t in top] == [r.t for r in want] and [t["count"] for t in top] == pytest.approx([r["count"] for r in want], rel=0.02)


def test_empty_table(rows):
    assert report(merge_sketches(sketch_profile(rows.limit(0), COLUMNS, F.col("day")))).count() == 0
