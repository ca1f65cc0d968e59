import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm.multi_index import traverse
from lotwise.llm.nearest import _meeting, nearest
from lotwise.llm.vector_dedup import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, node string, i int"
NAN, INF = float("nan"), float("inf")
UNUSABLE = [None, [0.0] * 8, [1.0, None] + [0.0] * 6, [NAN] + [1.0] * 7, [INF] + [1.0] * 7, [], [1.0, 2.0]]


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [x if x is None else float(x) for x in v], lab, 1, "n", 2) for i, v, lab in rows], SCHEMA)


def usable(v):
    return v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def clustered(n, seed=0, size=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // 12), size))
    out = centres[rng.integers(len(centres), size=n)] + 0.05 * rng.normal(size=(n, size))
    return np.float32(out)


def test_traversal_visits_all_cells_by_rising_sum():
    rng = np.random.default_rng(5)
    for a, b in ((1, 1), (1, 6), (5, 4), (9, 9)):
        x, y = rng.integers(0, 6, a).astype(float), rng.integers(0, 6, b).astype(float)
        cells = list(traverse(x, y))
        assert sorted(cells) == sorted(itertools.product(range(a), range(b)))
        sums = [x[i] + y[j] for i, j in cells]
        assert sums == sorted(sums)


def exact(rows, k=10):
    data = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v, _ in rows if i is not None and usable(v)]
    out = {}
    for q, x in data:
        if q % 100 == 0:
            far = sorted((math.sqrt(((x - v) ** 2).sum()), i) for i, v in data if i != q)
            out[q] = [(i, d) for d, i in far[:k]]
    return out


def check_nearest(spark, rows, least=0.9):
    got = {}
    for r in nearest(table(spark, rows), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = exact(rows)
    hits = 0
    assert set(got) == {q for q in want if want[q]}
    for q in got:
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, len(want[q]) + 1))
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        true = {i: d for i, d in want[q]}
        hits += sum(v in true for _, v, _ in found)
        assert all(s == pytest.approx(true[v], abs=1e-12) for _, v, s in found if v in true)
    if want:
        assert hits >= least * sum(map(len, want.values()))


def test_nearest_of_real_vectors(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    data = {i: np.array(v, dtype=float) for i, v, _ in rows}
    got = {}
    for r in nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & {i for _, i in sorted((((data[q] - v) ** 2).sum(), i) for i, v in data.items() if i != q)[:10]}) for q in got)
    assert len(got) == 5 and hits >= 0.9 * 50


def test_nearest_of_odd_vectors(spark):
    rows = [(k, v.tolist(), 1) for k, v in enumerate(clustered(900))]
    rows += [(2000 + k, rows[0][1], None) for k in range(40)] + [(3000 + k, v, 1) for k, v in enumerate(UNUSABLE)] + [(None, rows[5][1], 1)]
    check_nearest(spark, rows)


@pytest.mark.parametrize("block", [2, 7, 1000])
def test_each_visit_meets_each_entry_of_its_cells_once(spark, block):
    rng = np.random.default_rng(block)
    entries = [(int(rng.integers(4)) if v % 3 else 1, int(rng.integers(5)) if v % 3 else 2, v, [float(v)]) for v in range(120)]
    visits = [(q, q % 2, [0.5], i, sorted(map(int, rng.choice(5, rng.integers(1, 6), replace=False)))) for q in range(40) for i in range(4) if (q + i) % 3]
    visits = [v for v in visits if v[3] != 3]  # a code that nobody visits
    left, right = _meeting(spark.createDataFrame(entries, "i int, j int, vec_id long, vector array<double>"),
                           spark.createDataFrame(visits, "query_id long, query_key long, vector array<double>, i int, js array<int>"), 4, 5, block)
    met = left.drop("vector").join(right.drop("vector"), ["i", "part", "block", "query_block"]).where(F.array_contains("js", F.col("j")))
    got = sorted((r["query_id"], r["vec_id"]) for r in met.collect())
    assert got == sorted((q, v) for q, _, _, i, js in visits for a, j, v, _ in entries if a == i and j in js)
    assert left.where("i = 3").count() == 0
    assert left.groupBy("vec_id").count().agg(F.max("count")).first()[0] <= max(1, -(-len(visits) // block))
    if block == 1000:  # one block of visits: every entry that is visited has one place
        assert left.count() == left.select("vec_id").distinct().count()


def test_few_and_no_candidates(spark):
    few = [(100 * k, v.tolist(), 1) for k, v in enumerate(clustered(4))]
    check_nearest(spark, few, least=1.0)
    check_nearest(spark, few[:1])
    check_nearest(spark, [])
    check_nearest(spark, [(200, None, 1)])


def links(rows, threshold=0.93):
    data = [(k, np.array(v, dtype=np.float32).astype(float)) for k, (_, v, lab) in enumerate(rows) if lab is not None and usable(v)]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, x), (b, y) in itertools.combinations(data, 2):
        if rows[a][2] == rows[b][2] and (x @ y) / math.sqrt((x @ x) * (y @ y)) >= threshold:
            n[a] += 1
            n[b] += 1
            root[find(a)] = find(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((str(i), n[k], str(least.get(find(k))), i is not None and least[find(k)] == i) for k, (i, _, _) in enumerate(rows))


def check_links(spark, rows):
    got = near_duplicates(table(spark, rows)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == links(rows)


def test_links_of_near_copies(spark):
    vectors = clustered(700, seed=2)
    rows = [(k, v.tolist(), k % 3) for k, v in enumerate(vectors)]
    rows += [(1000 + k, rows[7][1], 1) for k in range(60)] + [(1100 + k, (3.5 * vectors[9]).tolist(), 0) for k in range(5)]
    rows += [(2000 + k, v, 1) for k, v in enumerate(UNUSABLE)] + [(3000, rows[0][1], None), (None, rows[0][1], 0), (5, rows[50][1], 2), (5, rows[50][1], 2)]
    check_links(spark, rows)


def test_links_of_one_large_group(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=8)
    check_links(spark, [(k, (base + 0.12 * rng.normal(size=8)).tolist(), 4) for k in range(400)])


def test_links_of_no_vectors(spark):
    check_links(spark, [])
    check_links(spark, [(1, None, 1), (2, [1.0] * 8, None), (3, [0.0] * 8, 1)])


def spread_pairs(rng, n, cosine=0.932, size=16):
    """Vectors in all directions, each beside one that is just close enough."""
    x = rng.normal(size=(n, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.normal(size=(n, size))
    u -= (u * x).sum(1)[:, None] * x
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    return np.concatenate([x, cosine * x + math.sqrt(1 - cosine * cosine) * u])


def found_of(spark, vectors):
    """Per vector the links found and those there are."""
    x = np.float32(vectors).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.93).sum(1) - 1
    got = {r.vec_id: r.n_links for r in near_duplicates(table(spark, [(k, v.tolist(), 1) for k, v in enumerate(vectors)])).collect()}
    return np.array([got[k] for k in range(len(x))]), want


def test_links_of_fifty_thousand_vectors(spark):
    """Pairs in all directions, groups of ten, a group of a sixth of the rows, and single vectors, under eight labels."""
    rng = np.random.default_rng(3)
    tens = np.repeat(rng.normal(size=(800, 16)), 10, axis=0) + 0.05 * rng.normal(size=(8000, 16))
    group = rng.normal(size=16) + 0.01 * rng.normal(size=(8000, 16))
    x = np.float32(np.concatenate([spread_pairs(rng, 3000), tens, group, rng.normal(size=(28_000, 16))]))
    label = np.concatenate([np.tile(np.arange(3000) % 8, 2), np.repeat(np.arange(800) % 8, 10), np.full(8000, 3), rng.integers(0, 8, 28_000)])
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = np.zeros(len(x), dtype=int)
    for k in range(8):
        own = np.flatnonzero(label == k)
        for part in np.array_split(own, 8):
            want[part] = (unit[part] @ unit[own].T >= 0.93).sum(1) - 1
    frame = table(spark, [(int(k), v, int(c)) for k, (v, c) in enumerate(zip(x.tolist(), label))])
    got = {r.vec_id: r.n_links for r in near_duplicates(frame).collect()}
    found = np.array([got[k] for k in range(len(x))])
    kinds = [("pairs", 0, 6000), ("tens", 6000, 14_000), ("group", 14_000, 22_000), ("single", 22_000, 50_000)]
    assert (found <= want).all()
    for name, low, high in kinds:
        assert found[low:high].sum() >= 0.99 * want[low:high].sum(), name


def test_pairs_beside_a_large_group_are_found(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=16)
    group = base + 0.01 * rng.normal(size=(2000, 16))
    found, want = found_of(spark, np.concatenate([spread_pairs(rng, 2500), group]))
    assert (found <= want).all() and (found[5000:] >= 0.99 * want[5000:]).all()
    assert found[:5000].sum() >= 0.99 * want[:5000].sum()


def test_rare_pairs_are_found(spark, monkeypatch):
    monkeypatch.setattr("lotwise.llm.vector_dedup.TRIAL_VECTORS", 8)
    monkeypatch.setattr("lotwise.llm.vector_dedup.MOST_TRIAL_VECTORS", 32, raising=False)
    rng = np.random.default_rng(9)
    found, want = found_of(spark, np.concatenate([spread_pairs(rng, 100), rng.normal(size=(6000, 16))]))
    assert want.sum() >= 200 and (found == want).all()
