import random
from datetime import datetime, timedelta

import pytest

from lotwise.operators.asof import asof_join

START = datetime(2024, 1, 1)


def made(spark, n, m, seed, hot=0.5):
    r = random.Random(seed)
    key = lambda: "hot" if r.random() < hot else r.choice(["a", "b", "c", None])
    at = lambda: None if r.random() < 0.03 else START + timedelta(minutes=r.randint(0, 600_000))
    left = [(k, key(), at()) for k in range(n)]
    right = [(key(), at(), r.choice([None, 1.0, 2.5, float(k)]), f"v{k}") for k in range(m)]
    right += [(*right[0][:2], 99.0, "tie")] if m else []
    return (spark.createDataFrame(left, "id long, code string, day timestamp"), left,
            spark.createDataFrame(right, "code string, since timestamp, rate double, note string"), right)


def by_search(left, right):
    out = []
    for i, code, day in left:
        seen = [(s, (rate is not None, rate or 0.0, note), rate, note) for c, s, rate, note in right
                if code is not None and day is not None and c == code and s is not None and s <= day]
        best = max(seen, default=(None, None, None, None))
        out.append((i, code, day, best[2], best[3]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [3600, 86_400 * 30, 10**9])
def test_like_a_search(spark, width):
    left, rows, right, others = made(spark, 400, 300, 1)
    got = asof_join(left, right, "day", "since", "code", "code", ["rate", "note"], width)
    assert got.columns == ["id", "code", "day", "rate", "note"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_search(rows, others)


def test_before_the_first_at_the_same_time_and_repeated(spark):
    left = spark.createDataFrame([(1, "a", START), (1, "a", START), (2, "a", START - timedelta(seconds=1)), (3, "a", START + timedelta(days=900)), (4, "z", START)],
                                 "id long, code string, day timestamp")
    right = spark.createDataFrame([("a", START, 5.0)], "code string, since timestamp, rate double")
    got = sorted((r.id, r.rate) for r in asof_join(left, right, "day", "since", "code", "code", ["rate"]).collect() if r.rate)
    assert got == [(1, 5.0), (1, 5.0), (3, 5.0)]
    assert asof_join(left, right, "day", "since", "code", "code", ["rate"]).count() == 5


def test_empty_sides_and_clashes(spark):
    left, rows, right, _ = made(spark, 20, 10, 2)
    assert asof_join(left.limit(0), right, "day", "since", "code", "code", ["rate"]).count() == 0
    assert [r.rate for r in asof_join(left, right.limit(0), "day", "since", "code", "code", ["rate"]).collect()] == [None] * 20
    odd = left.withColumnsRenamed({"id": "window"}).selectExpr("*", "1 as side", "2 as `key`", "3 as row")
    assert asof_join(odd, right, "day", "since", "code", "code", ["rate"]).columns == [*odd.columns, "rate"]
    with pytest.raises(ValueError):
        asof_join(left, right, "day", "since", "code", "code", ["code"])
