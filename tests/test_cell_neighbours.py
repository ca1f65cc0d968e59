import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotwise.operators import cell_neighbours as C, hashed_neighbours as H
from lotwise.operators.hashed_neighbours import knn_hashed
from tests.test_hashed_neighbours import vectors, wide
from tests.test_neighbours import brute


@pytest.fixture(autouse=True)
def many(monkeypatch):
    monkeypatch.setattr(H, "GRID_POINTS", 0)


def test_all_cells_give_the_exact_mean(spark, monkeypatch):
    """With every cell visited the result is brute force's, copies and equal distances too; parts are small, so there are many."""
    monkeypatch.setattr(C, "MOST_POINTS", 40)
    x, q = wide(400, 1), np.vstack([wide(40, 2), wide(400, 1)[:20]])
    x[:150, :4] = np.round(x[:150, :4])
    y = np.random.default_rng(3).normal(size=len(x))
    out, fit = knn_hashed(vectors(spark, x, y), vectors(spark, q), 60, "y", "id", recall=1.01)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(q) and fit.probes == len(fit.centres) > 60
    for i, row in enumerate(q):
        assert got[i]["predicted"] == pytest.approx(brute(x, y, row, 5), rel=1e-7) and got[i]["found"] == 5


def test_recall_without_a_row_for_each_visit(spark, monkeypatch):
    """A query is sent to the parts that hold its cells; the tables sent its vector once for each cell and table."""
    sent, rows = [], C._query_rows
    monkeypatch.setattr(C, "_query_rows", lambda *a: sent.append(C.materialize(rows(*a), "sent")) or sent[-1])
    x, q = wide(6000, 4), wide(200, 5)
    y = x[:, 0] + np.random.default_rng(6).normal(size=len(x)) * 0.1
    out, fit = knn_hashed(vectors(spark, x, y), vectors(spark, q), 60, "y", "id")
    got = np.array([r["predicted"] for r in out.orderBy("id").collect()])
    want = np.array([brute(x, y, row, 5) for row in q])
    assert fit.recall >= 0.97 and 1 < fit.probes < len(fit.centres)
    assert (np.abs(got - want) < 1e-7).mean() >= 0.85 and np.abs(got - want).mean() < 0.03
    asked = len(np.unique(q, axis=0))
    assert sum(s.count() for s in sent) <= 3 * asked < asked * fit.probes


def test_nulls_and_empty_queries(spark):
    x = wide(50, 7)
    train = vectors(spark, x, np.arange(50.0))
    none = F.lit(None).cast(train.schema["features"].dataType)
    train = train.unionByName(train.where("id < 3").withColumn("y", F.lit(None).cast("double"))).unionByName(train.limit(1).withColumn("features", none))
    asked = vectors(spark, x[:4])
    asked = asked.unionByName(asked.where("id = 1")).unionByName(asked.where("id = 0").withColumn("features", none))
    out, _ = knn_hashed(train, asked, 60, "y", "id", k=1, recall=1.01)
    got = sorted((r["id"], r["predicted"] is None, r["found"]) for r in out.collect())
    assert got == [(0, False, 1), (0, True, 0), (1, False, 1), (1, False, 1), (2, False, 1), (3, False, 1)]
    assert knn_hashed(train, asked.limit(0), 60, "y", "id")[0].count() == 0


def test_parts_are_bounded():
    """Cells side by side share a part; a crowded cell is dealt to several, a busy part to several tasks."""
    rng = np.random.default_rng(5)
    centres, held, asked = rng.normal(size=(200, 3)), rng.integers(0, 30, 200), np.full(200, 10)
    held[7], asked[7] = 1000, 5000
    parts = C.deal(centres, held, asked, 100)
    load = np.bincount(np.repeat(parts.first, parts.shares) + np.concatenate([np.arange(s) for s in parts.shares]),
                       np.repeat(np.ceil(held / parts.shares), parts.shares))
    assert load.max() <= 110 and parts.shares[7] >= 10 and (np.delete(parts.shares, 7) == 1).all()
    assert parts.copies[parts.first[7]] > 1 and len(parts.copies) == len(load)
    assert parts.task.tolist() == (np.cumsum(parts.copies) - parts.copies).tolist()


def test_reduced_distances_are_never_too_long():
    rng = np.random.default_rng(8)
    x = wide(300, 9)
    mean, axes = x.mean(axis=0), np.linalg.qr(rng.normal(size=(60, 7)))[0]
    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    rows = pa.array([{"type": 0, "size": 60, "indices": np.flatnonzero(r).tolist(), "values": r[r != 0].tolist()} for r in np.vstack([np.zeros(60), x])], kind)
    y = C.Cells(mean, axes, np.zeros((1, 7), np.float32)).reduced(rows.slice(1))
    far = lambda a: np.sqrt(((a[:, None].astype(float) - a[None]) ** 2).sum(axis=2))
    assert (far(y) <= far(x) + 1e-3).all() and np.corrcoef(far(y).ravel(), far(x).ravel())[0, 1] > 0.8
