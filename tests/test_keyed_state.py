"""Replays and sessions give what a batch over the same rows gives, however the files cut the stream."""

import os
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest

from lotwise.streaming.monitor import sessions
from lotwise.streaming.replays import MARKS, ROCKSDB, FirstOfRequest, keyed_state, replays_dropped_for
from lotwise.streaming.runner import run_to_files

SCHEMA = "request long, client string, at timestamp, value double"
START, HOUR = datetime(2024, 1, 1, tzinfo=timezone.utc), timedelta(hours=1)
DELAY, KEEP, GAP = timedelta(days=1), timedelta(days=20), timedelta(hours=2)


def requests(n=300, seed=5):
    """Over 30 days; one client has a third of the rows, a third of the requests come again, up to four times."""
    rng = np.random.default_rng(seed)
    rows = []
    for r in range(n):
        client = "hot" if r % 3 == 0 else f"c{rng.integers(12)}"
        at = START + HOUR * float(rng.uniform(0, 720))
        copies = int(rng.integers(1, 5)) if rng.random() < 0.33 else 0
        rows += [(r, client, at + HOUR * float(k), float(r % 7)) for k in [0, *rng.uniform(0, 1000, copies)]]
    return sorted(rows, key=lambda r: r[2])


def passed_once(rows, keep=KEEP):
    first, out = {}, []
    for row in sorted(rows, key=lambda r: (r[2], r[1], r[3])):
        if row[0] not in first or row[2] >= first[row[0]] + keep:
            first[row[0]] = row[2]
            out.append(row)
    return out


def closed(rows, last):
    out = {}
    for _, client, at, value in sorted(rows, key=lambda r: r[2]):
        runs = out.setdefault(client, [])
        if runs and at <= runs[-1][-1][0] + GAP:
            runs[-1].append((at, value))
        else:
            runs.append([(at, value)])
    return sorted((c, r[0][0], r[-1][0], len(r), round(sum(v for _, v in r) / len(r), 6)) for c, runs in out.items() for r in runs if r[-1][0] + GAP <= last - DELAY)


def as_stream(spark, batches, folder):
    """One file a batch, read in this order."""
    os.makedirs(folder)
    for k, batch in enumerate(batches):
        frame = pd.DataFrame(batch, columns=["request", "client", "at", "value"])
        frame["at"] = pd.to_datetime(frame["at"], utc=True).astype("datetime64[us, UTC]")
        frame.astype({"request": "Int64", "value": "float64"}).to_parquet(f"{folder}/{k:03}.parquet", index=False)
        os.utime(f"{folder}/{k:03}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def cut(rows, parts, jitter=0, seed=1):
    """Batches by time; with ``jitter`` rows come up to so much later than they should."""
    rng = np.random.default_rng(seed)
    shown = sorted(rows, key=lambda r: r[2] + jitter * DELAY * float(rng.random()))
    return [list(map(tuple, shown[a:b])) for a, b in zip(np.linspace(0, len(rows), parts + 1).astype(int), np.linspace(0, len(rows), parts + 1).astype(int)[1:])]


SPLITS = [(1, 0), (4, 0), (7, 0.9)]


@pytest.mark.parametrize("parts,jitter", SPLITS)
def test_first_of_each_request(spark, tmp_path, parts, jitter):
    rows = requests()
    batches = cut(rows, parts, jitter)
    with keyed_state(spark):
        path = run_to_files(replays_dropped_for(as_stream(spark, batches, tmp_path / "in"), ["request"], "at", KEEP), "first", str(tmp_path / "out"))
    got = spark.read.parquet(path)
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in passed_once(rows))
    if not jitter:  # out of order within the delay, a repeat may come before the first one
        assert [(r, at.timestamp()) for r, at in sorted((r["request"], r["at"]) for r in got.collect())] == \
            [(r, at.timestamp()) for r, at in sorted((r[0], r[2]) for r in passed_once(rows))]


@pytest.mark.parametrize("parts,jitter", SPLITS)
def test_sessions(spark, tmp_path, parts, jitter):
    rows = passed_once(requests(), timedelta(days=1000))
    batches = cut(rows, parts, jitter)
    path = run_to_files(sessions(as_stream(spark, batches, tmp_path / "in"), "client", "at", "value", "2 hours", "1 day"), "sessions", str(tmp_path / "out"))
    got = [(r["client"], r["first_at"].timestamp(), r["last_at"].timestamp(), r["rows"], round(r["mean"], 6)) for r in spark.read.parquet(path).collect()]
    want = [(c, a.timestamp(), b.timestamp(), n, m) for c, a, b, n, m in closed(rows, max(r[2] for r in rows))]
    assert sorted(got) == sorted(want) and any(r[3] > 1 for r in want)


@pytest.mark.parametrize("parts", [1, 3])
def test_sessions_of_first_requests(spark, tmp_path, parts):
    rows = requests()
    with keyed_state(spark):
        once = replays_dropped_for(as_stream(spark, cut(rows, parts), tmp_path / "in"), ["request"], "at", KEEP)
        path = run_to_files(sessions(once, "client", "at", "value", "2 hours", delay=None), "sessions", str(tmp_path / "out"))
    got = [(r["client"], r["first_at"].timestamp(), r["rows"]) for r in spark.read.parquet(path).collect()]
    assert sorted(got) == sorted((c, a.timestamp(), n) for c, a, _, n, _ in closed(passed_once(rows), max(r[2] for r in rows)))


def test_nulls_ties_and_the_edges_of_time(spark, tmp_path):
    at = lambda days: START + timedelta(days=days)
    batches = [
        [(1, "b", at(0), 1.0), (1, "a", at(0), 2.0), (None, "a", at(0), 3.0), (2, "a", None, 4.0), (3, None, at(1), None), (3, None, at(1), None)],
        [(1, "a", at(20) - timedelta(microseconds=1), 5.0), (3, "z", at(20), 6.0)],
        [(1, "a", at(20), 7.0)],
        [(1, "a", at(30), 8.0), (9, "a", at(60), 9.0)],
        [(3, "z", at(60), 10.0)],
    ]
    with keyed_state(spark):
        path = run_to_files(replays_dropped_for(as_stream(spark, batches, tmp_path / "in"), ["request"], "at", KEEP), "edges", str(tmp_path / "out"))
    got = sorted((r["request"], r["value"] or 0.0, r["client"] or "") for r in spark.read.parquet(path).collect())
    assert got == [(1, 2.0, "a"), (1, 7.0, "a"), (3, 0.0, ""), (3, 10.0, "z"), (9, 9.0, "a")]


def test_an_empty_stream_and_the_setting(spark, tmp_path):
    name = keyed_state.NAME
    before = spark.conf.get(name, None)
    with keyed_state(spark):
        assert spark.conf.get(name) == ROCKSDB
        path = run_to_files(replays_dropped_for(as_stream(spark, [[]], tmp_path / "in"), ["request"], "at", KEEP), "none", str(tmp_path / "out"))
    assert spark.conf.get(name, None) == before
    assert spark.read.schema(SCHEMA).parquet(path).count() == 0


class CountedState:
    """Stands for the handle, its value state and its timers; counts the calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


def test_a_batch_calls_the_state_per_bucket_not_per_request():
    state = CountedState()
    first = FirstOfRequest("at", KEEP, ["request", "at"])
    first.init(state)

    def batch(hours):
        ids = np.arange(1000)
        at = pd.to_datetime([START + HOUR * h for h in hours]).tz_localize(None)
        rows = pd.DataFrame({"request": ids, "at": at, MARKS[0]: ids, MARKS[1]: ids})
        return sum(len(out) for out in first.handleInputRows((0,), iter([rows.iloc[:400], rows.iloc[400:]]), None))

    assert batch([0.0] * 1000) == 1000 and batch([1.0] * 1000) == 0
    assert batch([0.0] * 500 + [24 * 20.0] * 500) == 500  # keep has passed for half of them
    assert state.calls < 20 and len(state.timers) == 1
