import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lotwise.operators import training as T, tree_shapley as X
from lotwise.operators.kernel_shapley import coalitions, kernel_shapley, solution
from lotwise.operators.tree_shapley import Node, contributions, expected, leaf_shares, read_trees, slot_columns, tree_shapley
from lotwise.sources.scratch import materialize


def by_subsets(value, n):
    """Shapley values of the game ``value(frozenset)`` by all subsets."""
    out = []
    for i in range(n):
        others = [j for j in range(n) if j != i]
        out.append(sum(math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n) * (value(frozenset(s) | {i}) - value(frozenset(s)))
                       for k in range(n) for s in combinations(others, k)))
    return out


def value_of(node, row, known, members):
    if node.left is None:
        return node.value
    if members[node.slot] in known:
        return value_of(node.left if node.goes_left(np.array([row[node.slot]]))[0] else node.right, row, known, members)
    return sum(c.weight / node.weight * value_of(c, row, known, members) for c in (node.left, node.right))


def random_tree(rng, depth, slots):
    if depth == 0 or rng.random() < 0.15:
        return Node(float(rng.normal()), float(rng.integers(1, 20)))
    left, right = random_tree(rng, depth - 1, slots), random_tree(rng, depth - 1, slots)
    kind = {"threshold": float(rng.normal())} if rng.random() < 0.7 else {"categories": (0.0,)}
    return Node(0.0, left.weight + right.weight, int(rng.integers(slots)), left=left, right=right, **kind)


@pytest.mark.parametrize("members", [[0, 1, 2, 3, 4], [0, 0, 1, 2, 1]])
def test_shares_are_the_sum_over_all_subsets(members):
    rng = np.random.default_rng(4)
    n = max(members) + 1
    for _ in range(12):
        trees = [(0.5, random_tree(rng, 5, 5)), (2.0, random_tree(rng, 3, 5))]
        rows = np.where(rng.random((7, 5)) < 0.3, 0.0, rng.normal(size=(7, 5)))
        got = contributions(trees, {s: rows[:, s] for s in range(5)}, members, n, 7)
        for k, row in enumerate(rows):
            value = lambda known: sum(w * value_of(t, row, known, members) for w, t in trees)  # noqa: E731, B023
            assert np.allclose(got[:, k], by_subsets(value, n), atol=1e-12)
            assert math.isclose(got[:, k].sum(), value(frozenset(range(n))) - sum(w * expected(t) for w, t in trees), abs_tol=1e-12)


def test_leaf_shares_of_one_member():
    assert np.allclose(leaf_shares(np.array([[1.0], [0.0]]), np.array([0.25])), [[0.75], [-0.25]])


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(400, 4)), 2)
    y = np.where(x[:, 0] > 0, x[:, 1] * 2, x[:, 2]) + 0.1 * rng.normal(size=400)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "listing_id long, a double, b double, c double, d double, price_log double")
    return VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df)


@pytest.mark.parametrize("name,params", [("tree", {"maxDepth": 4}), ("forest", {"numTrees": 5, "maxDepth": 4}), ("boosting", {"maxIter": 4, "maxDepth": 3})])
def test_fitted_models_add_up(small, name, params):
    model = T.learner(name, **params).fit(small)
    rows = tree_shapley(small, model, list("abcd"))
    assert rows.columns == ["listing_id", "feature", "contribution", "base"] and rows.count() == 1600
    sums = rows.groupBy("listing_id").agg(F.sum("contribution").alias("s"), F.max("base").alias("base"))
    joined = model.transform(small).join(sums, "listing_id")
    assert joined.where(F.abs(F.col("prediction") - F.col("base") - F.col("s")) > 1e-9).count() == 0
    assert math.isclose(rows.first()["base"], sum(w * expected(t) for w, t in read_trees(model)))


def test_unused_features_have_nothing(spark, small):
    flat = T.learner("tree", maxDepth=3).fit(small.withColumn("price_log", F.lit(2.0)))
    rows = tree_shapley(small, flat, list("abcd")).collect()
    assert len(rows) == 1600 and all(r.contribution == 0 and r.base == 2 for r in rows)
    assert tree_shapley(small.limit(0), T.learner("tree", maxDepth=3).fit(small), list("abcd")).count() == 0


def test_slots_of_one_column_are_one_player(raw):
    from lotwise.plans.common import builder

    d = T.prepare(raw, builder(), numeric=["car_age", "engine_size_cc_log", "annual_insurance"], text=["fuel_type_cleaned", "body_type_cleaned"])
    columns = slot_columns(d.encoder)
    assert len(columns) == len(d.encoder.names) and set(columns) == {"car_age", "engine_size_cc_log", "annual_insurance", "fuel_type_cleaned", "body_type_cleaned"}
    model = T.learner("forest", numTrees=3, maxDepth=5).fit(d.train)
    trees, names = read_trees(model), list(dict.fromkeys(columns))
    members = [names.index(c) for c in columns]
    some = d.test.orderBy("listing_id").limit(5)
    got = {}
    for r in tree_shapley(some, model, columns).collect():
        got.setdefault(r.listing_id, {})[r.feature] = r.contribution
    for r in some.collect():
        row = r.features.toArray()
        want = by_subsets(lambda known: sum(w * value_of(t, row, known, members) for w, t in trees), len(names))  # noqa: B023
        assert np.allclose([got[r.listing_id][n] for n in names], want, atol=1e-10)


def test_all_coalitions_give_exact_values():
    rng = np.random.default_rng(1)
    for d in range(2, 9):
        z, w = coalitions(d, 2 ** d)
        assert len(z) == 2 ** d - 2
        values = {frozenset(np.flatnonzero(r)): float(rng.normal()) for r in np.vstack([np.zeros(d), np.ones(d), z])}
        v = np.array([values[frozenset(np.flatnonzero(r))] for r in np.vstack([np.zeros(d), np.ones(d), z])])
        assert np.allclose(v @ solution(z, w), by_subsets(values.__getitem__, d), atol=1e-9)


def test_drawn_coalitions_come_close_and_add_up():
    z, w = coalitions(16, 1200)
    assert len(z) <= 1200 and len({tuple(r) for r in z}) == len(z)
    beta = np.random.default_rng(3).normal(size=16)
    v = np.r_[1.0, 1.0 + beta.sum(), 1.0 + z @ beta]
    assert np.allclose(v @ solution(z, w), beta, atol=1e-8)  # a linear game is exact with any coalitions
    v = np.r_[0.0, 1.0, (z[:, 0] * z[:, 1] + z[:, 2:].sum(1)) / 15]
    got = v @ solution(z, w)
    assert math.isclose(got.sum(), 1.0) and np.allclose(got, [1 / 30] * 2 + [1 / 15] * 14, atol=0.01)


def test_one_feature_and_crossed_features(small):
    def score(df):
        return df.withColumn("prediction", F.col("a") * F.col("b") + F.col("c"))

    got = {}
    ground = [(r.a, r.b, r.c) for r in _sample(small, 6, 7)]
    for r in kernel_shapley(small, ["a", "b", "c"], score, explained=4, background=6).collect():
        got.setdefault(r.listing_id, {})[r.feature] = (r.contribution, r.base)
    for r in _sample(small, 4, None):
        own = (r.a, r.b, r.c)

        def value(known):
            rows = [[own[i] if i in known else g[i] for i in range(3)] for g in ground]  # noqa: B023
            return sum(a * b + c for a, b, c in rows) / len(rows)

        assert np.allclose([got[r.listing_id][f][0] for f in "abc"], by_subsets(value, 3)) and math.isclose(got[r.listing_id]["a"][1], value(frozenset()))
    (one,) = kernel_shapley(small, ["a"], lambda df: df.withColumn("prediction", F.col("a") * 2), explained=1, background=6).collect()
    own = _sample(small, 1, None)[0].a
    assert math.isclose(one.contribution, 2 * (own - sum(g[0] for g in ground) / 6))


def _sample(df, n, seed):
    from lotwise.operators.split import sample_rows

    return sample_rows(df.select("listing_id", "a", "b", "c"), n, "listing_id", **({} if seed is None else {"seed": seed})).collect()


def test_patterns_of_a_leaf_are_not_sorted(monkeypatch):
    """Shares don't depend on the batch that a row is in, and no leaf sorts its rows."""
    from lotwise.operators import tree_shapley as module

    rng = np.random.default_rng(8)
    trees, x = [(1.0, random_tree(rng, 6, 5))], rng.normal(size=(40, 5))
    monkeypatch.setattr(module.np, "unique", lambda *a, **kw: pytest.fail("rows were sorted"))
    whole = contributions(trees, {s: x[:, s] for s in range(5)}, [0, 1, 2, 3, 4], 5, 40)
    for k in range(40):
        assert whole[:, k] == pytest.approx(contributions(trees, {s: x[k:k + 1, s] for s in range(5)}, [0, 1, 2, 3, 4], 5, 1)[:, 0], abs=1e-12)


def test_rows_to_explain_stay_sparse(small, capsys):
    """Their vectors are sent as they are; an array of all slots that the trees use was made of each row."""
    model = T.learner("tree", maxDepth=3).fit(small)
    small = materialize(small, "small")
    tree_shapley(small, model, list("abcd")).explain()
    assert "UDF(" not in capsys.readouterr().out
    none = small.withColumn("features", F.when(F.col("listing_id") > 0, F.col("features")))
    with pytest.raises(Exception, match="has no vector"):
        tree_shapley(none, model, list("abcd")).collect()


def test_shares_of_a_code_are_computed_once(monkeypatch):
    """Batches after the first read them; a table that is too wide is made for the codes that occur."""
    rng = np.random.default_rng(12)
    trees = [(1.0, random_tree(rng, 6, 5)), (0.5, random_tree(rng, 5, 5))]
    x = rng.normal(size=(60, 5))
    values = lambda a, b: lambda root: {s: x[a:b, s] for s in range(5)}
    calls, plain = [], X.leaf_shares
    monkeypatch.setattr(X, "leaf_shares", lambda *a: calls.append(1) or plain(*a))
    shares = X.Shares(trees, [0, 1, 2, 3, 4], 5)
    first = shares.of(values(0, 30), 30)
    made = len(calls)
    second = shares.of(values(30, 60), 30)
    assert made and len(calls) == made
    monkeypatch.setattr(X, "MOST_BITS", 1)
    again = X.Shares(trees, [0, 1, 2, 3, 4], 5).of(values(0, 60), 60)
    assert again == pytest.approx(np.hstack([first, second]), abs=1e-12)
