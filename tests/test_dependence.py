from itertools import combinations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.operators import counterfactuals as CF
from strataflow.operators import dependence as PD
from strataflow.operators import models as J
from strataflow.operators import training as TR

SCHEMA = "k long, split string, label int, features array<double>"


def data(spark, n=300, d=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).round(2)
    y = np.where(x[:, 0] > 1, 2, np.where(x[:, 1] + 0.5 * x[:, 2] > 0.3, 1, 0))
    rows = [(i, "val" if i % 5 == 0 else "train", int(y[i]), x[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA), x


def test_trees_equal_brute_force_averaging(spark):
    df, x = data(spark)
    model = J.train_trees(df, 3, max_iter=4, max_depth=4).models[1]
    trees = PD.trees_of(spark, model)

    def margin(rows):
        out = np.zeros(len(rows))
        for t in trees:
            at = np.zeros(len(rows), dtype=int)
            while (t.feature[at] >= 0).any():
                inner = t.feature[at] >= 0
                go = rows[np.arange(len(rows)), np.maximum(t.feature[at], 0)] <= t.threshold[at]
                at = np.where(inner, np.where(go, t.left[at], t.right[at]), at)
            out += t.weight * t.value[at]
        return out

    probs = J.vector_to_array(F.col("rawPrediction"))
    raw = np.array([r["r"] for r in model.transform(J.with_vector(df)).orderBy("k").select(F.get(probs, F.lit(1)).alias("r")).collect()])
    assert np.allclose(2 * margin(x), raw) or np.allclose(margin(x), raw)
    used = sorted({float(t) for tree in trees for f, t in zip(tree.feature, tree.threshold) if f == 1})
    grid = {0: [-1.0, 0.0, 0.99, 1.0, 5.0], 1: [*used, -9.0, 9.0], 3: [0.5]}  # the thresholds themselves, too
    bad = spark.createDataFrame([(900, "train", 0, None), (901, "train", 0, [1.0, None, 0.0, 0.0]), (902, "train", 0, [1.0])], SCHEMA)
    got = PD.tree_dependence(df.unionByName(bad).repartition(5), trees, grid, 4).collect()
    assert len(got) == sum(map(len, grid.values()))
    for r in got:
        moved = x.copy()
        moved[:, r.feature] = r.value
        assert r.mean_output == pytest.approx(margin(moved).mean(), abs=1e-10)
    assert all(r.mean_output is None for r in PD.tree_dependence(df.limit(0), trees, grid, 4).collect())


def test_logistic_equals_brute_force(spark):
    df, x = data(spark, 100)
    coef = np.random.default_rng(3).normal(size=(5, 3))
    grid = {0: [-2.0, 0.0, 1.5], 2: [0.25]}
    for r in PD.logistic_dependence(df.repartition(3), coef, grid).collect():
        moved = x.copy()
        moved[:, r.feature] = r.value
        z = moved @ coef[:-1] + coef[-1]
        assert r.mean_prob == pytest.approx((np.exp(z) / np.exp(z).sum(1, keepdims=True))[:, r["class"]].mean(), abs=1e-12)
    assert all(r.mean_prob is None for r in PD.logistic_dependence(df.limit(0), coef, grid).collect())


def smallest(model, x, moves, target, scales, most):
    """The least change by trying all of them."""
    def say(v):
        z = v @ model.coef[:-1] + model.coef[-1]
        return int(np.argmax(z))

    for n in range(most + 1):
        found = []
        for feats in combinations(sorted(moves), n):
            for values in product(*(moves[f] for f in feats)):
                if any(x[f] == v for f, v in zip(feats, values)):
                    continue
                moved = x.copy()
                moved[list(feats)] = values
                if say(moved) == target:
                    found.append((sum(abs(v - x[f]) / scales[f] for f, v in zip(feats, values)), list(zip(feats, values))))
        if found:
            return n, min(found)
    return None


def test_smallest_change_equals_brute_force_and_flips(spark):
    df, x = data(spark, 40)
    model = TR.FocalLogistic(4, 3, np.array([[0.2, -1.0, 1.5], [-1.0, 1.0, 0.3], [-0.5, 0.6, 0.1], [0.1, 0.2, -0.3], [0.8, 0.1, -2.2]]))
    moves = {0: [-1.0, 0.5, 1.0, 2.0], 1: [-1.0, 1.0, x[0, 1]], 3: [-2.0, 0.0]}
    scales = [1.0, 2.0, 1.0, 0.5]
    got = CF.counterfactuals(model.predict, df, "k", moves, 2, scales, beam=1000, max_changes=3).collect()
    assert len(got) == 40
    kinds = set()
    for r in got:
        want = smallest(model, x[r.k], moves, 2, scales, 3)
        kinds.add(want and want[0])
        if want is None:
            assert r.n_changes is None and r.counterfactual is None
            continue
        assert r.n_changes == want[0] and r.cost == pytest.approx(want[1][0])
        assert [tuple(c) for c in r.changes] == [(f, float(v)) for f, v in want[1][1]]
    assert kinds >= {None, 1, 2} or kinds >= {0, 1, 2}
    answers = [r for r in got if r.counterfactual is not None]
    again = spark.createDataFrame([(r.k, r.counterfactual) for r in answers], "k long, features array<double>")
    assert {r.prediction for r in model.predict(again).collect()} == {2}


def test_a_narrow_beam_still_flips_the_model(spark):
    df, _ = data(spark, 60)
    model = J.train_trees(df, 3, max_iter=3)
    moves = {j: [-2.0, 0.0, 2.0] for j in range(4)}
    got = CF.counterfactuals(model.predict, df, "k", moves, 2, beam=2, max_changes=2).where("n_changes > 0")
    flips = model.predict(got.select("k", F.col("counterfactual").alias("features")))
    assert got.count() > 20 and flips.where("prediction <> 2").count() == 0
    assert got.where(F.size("changes") != F.col("n_changes")).count() == 0


def test_rows_without_a_vector_and_no_rows(spark):
    df, _ = data(spark, 5)
    model = TR.FocalLogistic(4, 3, np.zeros((5, 3)))
    rows = df.unionByName(spark.createDataFrame([(99, "train", 0, None)], SCHEMA))
    got = {r.k: r.n_changes for r in CF.counterfactuals(model.predict, rows, "k", {0: [1.0]}, 0).collect()}
    assert got == {**dict.fromkeys(range(5), 0), 99: None}
    assert CF.counterfactuals(model.predict, df.limit(0), "k", {0: [1.0]}, 0).count() == 0
    assert {r.n_changes for r in CF.counterfactuals(model.predict, df, "k", {}, 2).collect()} == {None}
