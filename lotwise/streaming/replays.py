"""Requests that are answered once, however late they come again."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Columns that travel with the rows: the bucket, and 128 bits that stand for the key.
BUCKET, MARKS = "request__bucket", ["request__mark", "request__mark_2"]


class FirstOfRequest(StatefulProcessor):
    """Passes the earliest row of a request; remembers its time until ``keep`` has passed in event time.

    The requests of a bucket share one state value, (marks, first time) of each as packed numbers, so that a
    batch calls the state a few times per bucket and not per request. Its timer is that of the oldest one.
    """

    def __init__(self, time: str, keep: timedelta, columns: list[str]):
        self.time, self.keep, self.columns = time, keep // timedelta(microseconds=1), columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.firsts = handle.getValueState("firsts", "packed binary")

    def _read(self) -> np.ndarray:
        packed = self.firsts.get()[0] if self.firsts.exists() else b""
        return np.frombuffer(bytes(packed), dtype=np.int64).reshape(-1, 3)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        before = self._read()
        first = {(a, b): at for a, b, at in before.tolist()}
        batch = pd.concat(list(rows), ignore_index=True)
        again = batch.duplicated(MARKS, keep=False)
        if again.any():  # repeats in one batch, in order; the others have no order to keep
            ordered = batch[again].sort_values([self.time, *[c for c in self.columns if c != self.time]], kind="stable")
            batch = pd.concat([batch[~again], ordered], ignore_index=True)
        micros = batch[self.time].astype("datetime64[us]").astype("int64")
        passed = []
        for place, (a, b, at) in enumerate(zip(batch[MARKS[0]].tolist(), batch[MARKS[1]].tolist(), micros.tolist())):
            known = first.get((a, b))
            if known is None or at >= known + self.keep:
                first[a, b] = at
                passed.append(place)
        if passed:
            self._write(before, np.array([(a, b, at) for (a, b), at in first.items()], dtype=np.int64))
            yield batch.iloc[passed][self.columns]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        kept = self._read()
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        kept = kept[-(-(kept[:, 2] + self.keep) // 1000) > now]
        if len(kept):
            self.firsts.update((kept.tobytes(),))
            self.handle.registerTimer(_timer(kept, self.keep))
        else:
            self.firsts.clear()
        yield from ()

    def _write(self, before: np.ndarray, after: np.ndarray) -> None:
        self.firsts.update((after.tobytes(),))
        old, new = (_timer(x, self.keep) if len(x) else None for x in (before, after))
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(new)

    def close(self) -> None:
        pass


def _timer(firsts: np.ndarray, keep: int) -> int:
    """Milliseconds at which the oldest is forgotten, never before its time is up."""
    return int(-(-(firsts[:, 2].min() + keep) // 1000))


def replays_dropped_for(stream: DataFrame, key: list[str], time: str, keep: timedelta, delay: str = "1 day", buckets: int = 4096) -> DataFrame:
    """One row per request key within ``keep`` of its first one, also where the repeat carries a new time beyond
    the watermark's delay (``monitor.replays_dropped`` forgets a key after the delay).

    State is one time per key, dropped by a timer once the watermark is ``keep`` past it; a row later than that
    is a new request. Keys are told apart by two 64-bit hashes and share state in ``buckets``, which a batch
    rewrites where they have a new request; the number belongs to the checkpoint. Of repeats in one batch the
    earliest passes, at equal times the smallest by its other columns. Rows behind the watermark are dropped, as
    in any stream with one. Rows without a time or with a NULL in the key can't be told apart and are dropped.
    The stream needs the RocksDB state store: start it inside ``keyed_state``. What comes out keeps the
    watermark, so windows can follow.
    """
    timed = stream.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [time, *key])).withWatermark(time, delay)
    names = [F.col(f"`{c}`") for c in key]
    marked = timed.withColumns({MARKS[0]: F.xxhash64(*names), MARKS[1]: F.xxhash64(F.lit(1), *names)})
    dealt = marked.withColumn(BUCKET, F.pmod(F.col(MARKS[0]), F.lit(buckets)).cast("int"))
    return dealt.groupBy(BUCKET).transformWithStateInPandas(
        FirstOfRequest(time, keep, stream.columns), stream.schema, "Append", "EventTime", eventTimeColumnName=time)


class keyed_state:
    """The session's state store set to RocksDB for streams started inside, and set back after."""

    NAME = "spark.sql.streaming.stateStore.providerClass"

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(self.NAME, None)
        self.spark.conf.set(self.NAME, ROCKSDB)

    def __exit__(self, *_: Any) -> None:
        if self.before is None:
            self.spark.conf.unset(self.NAME)
        else:
            self.spark.conf.set(self.NAME, self.before)
